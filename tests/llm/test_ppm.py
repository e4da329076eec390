"""PPM scores and the unigram base against definitions worked out one symbol at a time."""

import math
import random
from collections import Counter

import ppm_reference as ref
import pytest
from pyspark.sql import functions as F

from seqweave.llm import ppm

ORDER = 3


def _rows():
    rng = random.Random(2)
    words = ["the", "then", "a", "B", "über", "漢字", "x" * 30, "0", "-"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 40]))) for _ in range(25)]
    texts += ["", None, " \t\n", "unseen Zeichen ¿", texts[0], texts[0], "a  b\x0bc\x1cd"]
    rows = [(i, t, i % 4 != 1, "clash") for i, t in enumerate(texts)]
    return rows + [rows[3], (None, "the a", False, "clash"), (None, None, True, "clash")]


SCHEMA = "doc_id long, text string, train boolean, score string"


@pytest.mark.parametrize("block_bytes, slice_chars", [(200, 1_000_000), (10_000_000, 1_000_000), (1000, 7)])
def test_scores(spark, block_bytes, slice_chars):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = ppm.score_texts(df, F.col("train"), order=ORDER, block_bytes=block_bytes, bucket_bytes=300,
                          slice_chars=slice_chars).collect()
    train = [t or "" for _, t, use, _ in rows if use]
    contexts = ref.train(train, ORDER)
    counts = Counter()
    for t in train:
        counts.update(ref.symbols(t, ORDER)[1])
        counts["end"] += 1
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t, _, _ in rows:
        tokens = [*ref.symbols(t or "", ORDER)[1], "end"]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        want.append((-1 if i is None else i, len(tokens), sum(counts[w] > 0 for w in tokens), n,
                     round(base, 6), round(ref.log10_probability(contexts, t or "", ORDER), 6)))
    mine = [(-1 if r._id is None else r._id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6),
             round(r.score, 6)) for r in got]
    for a, b in zip(sorted(mine), sorted(want), strict=True):
        assert a == pytest.approx(b, abs=2e-6)


def test_no_training_and_no_rows(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    got = ppm.score_texts(df, F.lit(False), order=2).filter(F.col("_id") == 25).first()  # the empty text
    assert got.score == pytest.approx(-math.log10(255)) and got.n_known == 0 and got.train_tokens == 0
    assert ppm.score_texts(df.limit(0), F.col("train")).count() == 0


def test_probabilities_sum_to_one(spark):
    """Over all symbols after one context, met or not."""
    contexts = ref.train(["abab abc", "abd"], 2)
    total = 0.0
    grams = []
    for s in [b for b in range(256) if b != 0xFE]:
        grams.append(((ord("a") << 16) | (ord("b") << 8) | s, contexts[(ord("a"), ord("b"))][s]))
    # the shallower tables need every gram's count, so all training grams go in
    have = {g for g, _ in grams}
    for ctx, seen in list(contexts.items()):
        if len(ctx) == 2:
            for s, n in seen.items():
                g = (ctx[0] << 16) | (ctx[1] << 8) | s
                if g not in have:
                    grams.append((g, n))
    lengths = ppm.code_lengths(spark.createDataFrame(grams, "gram long, c long"), 2)
    prefix = (ord("a") << 8) | ord("b")
    total = sum(10**r.bits10 for r in lengths.filter(F.shiftright("gram", 8) == prefix).collect())
    assert total == pytest.approx(1.0)


def test_block_size_and_long_texts_do_not_change_scores(spark):
    """Blocks of 1 MB and 32 MB; a text far above a block, one long word, and many short texts."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(500)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=200)), i % 5 != 1) for i in range(100)]
    rows += [(1000, " ".join(rng.choices(vocabulary, k=250_000)), True), (1001, "Wx" * 1_200_000, True), (1002, "wx" * 1_200_000, False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    got = []
    for block, size in ((1_000_000, 1_000_000), (32_000_000, 1_000_000), (32_000_000, 50_000_000)):
        scored = ppm.score_texts(df, F.col("train"), block_bytes=block, slice_chars=size)
        got.append(sorted((r._id, r.n_tokens, r.n_known, round(r.base_score, 4), round(r.score, 3)) for r in scored.collect()))
    assert got[0] == got[1]
    long = {r[0]: r for r in got[0]}
    assert long[1002][1:3] == (2, 2)
    for a, b in zip(got[0], got[2], strict=True):  # another size of slice names very long words otherwise
        assert a == pytest.approx(b, rel=1e-9)
