"""Token counts under edits and packing, against whole re-encoding by the tokenizers library."""

import bisect
import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seqweave.llm import packing_gga, queries, token_edits
from seqweave.llm.bpe import PreTokenCounter, encode, encoding
from seqweave.llm.queries import bpe_path

TEXTS = ["", " ", "a", "It's we'll  two   spaces\n\n\nend ", "Ünï çødé 漢字 12345 x'll 'll'", "<|endoftext|> a",
         "ab " * 700, "\t\r\n x", "don't'", "🙂🙂 zero​width", "x" * 3000]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe_path())
    t.encode_special_tokens = True
    return t


def test_ids_are_those_of_the_library(library):
    enc = encoding(bpe_path())
    for text in TEXTS:
        assert np.frombuffer(encode(enc, text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_tree_equals_full_recount(library):
    rng = random.Random(3)
    counter = PreTokenCounter(bpe_path())
    alphabet = ["a", "'", "s", "ll", " ", "  ", "\n", "1", "é", "!", "word ", "漢"]
    for trial in range(150):
        text = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 60, 2000])))
        tree = token_edits.TokenTree(text, counter)
        for _ in range(6):
            start, removed = rng.randint(0, len(text) + 1), rng.choice([0, 0, 1, 3, 50])
            new = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 4, 400])))
            tree.edit(start, removed, new)
            s = min(start, len(text))
            text = text[:s] + new + text[s + removed:]
            assert tree.text == text
            assert tree.n_tokens == len(library.encode(text, add_special_tokens=False).ids), (trial, text)
            assert [n for x in tree.lens for n in x] == list(map(len, counter.pattern.findall(text)))


def test_edits_touch_little():
    counter = PreTokenCounter(bpe_path())
    tree = token_edits.TokenTree("word and other words, " * 5000, counter)
    tree.edit(40_000, 3, "xyz")
    assert tree.encoded <= 5


def test_edit_rows(spark, library):
    edits = [[(0, 1, "new ")], None, [], [None, (2, None, "q"), (99, 5, None)]]
    rows = [(i % 3, TEXTS[i] if i else None, edits[i % 4], "clash") for i in range(len(TEXTS))] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, e array<struct<start:long,removed:long,inserted:string>>, n_tokens string")
    got = token_edits.edited_counts(df, bpe_path(), F.col("e"), with_text=True).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_tokens_after == len(library.encode(r.text_after, add_special_tokens=False).ids)
    empty = token_edits.edited_counts(df.limit(0), bpe_path(), F.col("e"))
    assert empty.count() == 0


ADDED = "<|endoftext|>"


def test_added_tokens_as_the_library_has_them(spark, tmp_path):
    library = Tokenizer.from_file(bpe_path())  # settings unchanged
    rng = random.Random(11)
    parts = [ADDED, ADDED[:5], ADDED[5:], "<|", "|>", "a", " ", "  ", "\n", "!", "'", "ll", "word ", "é"]

    def some(n):
        return "".join(rng.choice(parts) for _ in range(n))

    enc, counter = encoding(bpe_path(), added=True), PreTokenCounter(bpe_path(), added=True)
    for text in [f"a {ADDED} b", ADDED, *[some(rng.randint(0, 30)) for _ in range(300)]]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(enc, text), "<u4").tolist() == want, text
        tree = token_edits.TokenTree(text, counter)
        assert tree.n_tokens == len(want), text
        for _ in range(6):
            start, removed, new = rng.randint(0, len(text) + 1), rng.choice([0, 1, 3, 9]), some(rng.choice([0, 1, 3]))
            tree.edit(start, removed, new)
            s = min(start, len(text))
            text = text[:s] + new + text[s + removed:]
            assert tree.text == text
            assert tree.n_tokens == len(library.encode(text, add_special_tokens=False).ids), text
            assert [n for x in tree.lens for n in x] == [len(p) for _, p in counter.pieces(text)]
    rows = [(i, f"a {ADDED} b{i}" * (200 * i)) for i in range(3)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op1_token_edits(spark, str(tmp_path)).collect():
        assert r.n_tokens == len(library.encode(rows[r.doc_id][1], add_special_tokens=False).ids)
    want = []
    for i, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids + [2]
        want += [(i, p, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()))
                 for p, (s, n) in enumerate(packing_gga.cut(len(ids), 1024))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for got in (queries.op9_packing(spark, str(tmp_path)), corpus_pipeline.pack_sequences(spark, docs, str(tmp_path))):
        assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got.collect()) == want


def test_cut():
    assert packing_gga.cut(5, 10) == [(0, 5)]
    assert packing_gga.cut(10, 10) == [(0, 10)]
    assert packing_gga.cut(25, 10) == [(0, 5), (5, 10), (15, 10)]
    assert packing_gga.cut(20, 10) == [(0, 10), (10, 10)]


def _check_packing(rows, capacity):
    fill = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert fill.get(r.sequence_id, 0) == r.offset
        fill[r.sequence_id] = r.offset + r.length
    assert all(n <= capacity for n in fill.values())
    return len(fill)


def test_pack_rows(spark, library):
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, None])] + [(None, "a b", "x"), (1, " ", "y"), (1, " ", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string")
    pieces = packing_gga.document_pieces(df, bpe_path(), capacity=64)
    got = packing_gga.pack(pieces, capacity=64, islands=3, epochs=2, generations=10).collect()
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        for p, (s, n) in enumerate(packing_gga.cut(len(ids), 64)):
            want.append((i is None, i or 0, p, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())))
    assert sorted((r._id is None, r._id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    _check_packing(got, 64)
    assert packing_gga.pack(packing_gga.document_pieces(df.limit(0), bpe_path())).count() == 0


def _plain_best_fit_decreasing(sizes, capacity):
    free = []
    for s in sorted(sizes, reverse=True):
        at = bisect.bisect_left(free, s)
        bisect.insort(free, (free.pop(at) if at < len(free) else capacity) - s)
    return len(free)


def _pieces(spark, sizes):
    return spark.createDataFrame([(i, 0, 0, 0, n, 0) for i, n in enumerate(sizes)],
                                 "_id long, _row long, piece int, start long, length long, ids_crc32 long")


def test_packing_is_tight(spark):
    rng = random.Random(5)
    sizes = [rng.randint(1, 99) for _ in range(3000)]
    for parts in (1, 8):
        got = packing_gga.pack(_pieces(spark, sizes).repartition(parts), capacity=100).collect()
        assert sorted(r._id for r in got) == list(range(3000))
        bins = _check_packing(got, 100)
        assert bins <= 1.02 * max(-(-sum(sizes) // 100), sum(n > 50 for n in sizes))
        assert bins <= _plain_best_fit_decreasing(sizes, 100)


def test_genetic_steps_save_bins_on_hard_mixes(spark):
    rng = random.Random(7)
    for low, high in ((200, 500), (257, 400)):
        sizes = [rng.randint(low, high) for _ in range(2000)]
        got = [_check_packing(packing_gga.pack(_pieces(spark, sizes).repartition(p), 1024, islands=4, epochs=2, generations=60).collect(), 1024)
               for p in (1, 5)]
        assert got[0] == got[1] < 0.99 * _plain_best_fit_decreasing(sizes, 1024)


def test_packings_by_pattern():
    rng = random.Random(1)
    for trial in range(60):
        capacity = rng.choice([7, 60, 100])
        sizes = [rng.randint(1, capacity) for _ in range(rng.choice([1, 9, 200, 900]))]
        lengths = {s: sizes.count(s) for s in sizes}
        best = packing_gga.best_fit_decreasing(lengths, capacity)
        assert len(best) == _plain_best_fit_decreasing(sizes, capacity) >= packing_gga.least_bins(lengths, capacity)
        other = packing_gga.Packing(capacity).best_fit(sorted(lengths.items(), key=lambda x: rng.random()))
        for p in (best, other, packing_gga.crossover(best, other, rng), packing_gga.crossover(other, best, rng),
                  packing_gga.evolve(lengths, capacity, trial, [best, other], generations=5)[0]):
            assert p.lengths() == lengths and all(sum(x) <= capacity for x in p.bins)
        bins, offsets = packing_gga.Places(best.bins).of(np.array(sizes), np.array([sizes[:i].count(s) for i, s in enumerate(sizes)]))
        fill = {}
        for b, o, s in sorted(zip(bins.tolist(), offsets.tolist(), sizes)):
            assert fill.get(b, 0) == o
            fill[b] = o + s
        assert len(fill) == len(best) and max(fill.values()) <= capacity
