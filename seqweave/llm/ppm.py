"""Language-model scores by prediction by partial matching (PPM).

The model is a byte-context trie of depth ``order``, kept as one table per depth: a node is a gram
(its bytes packed into a number, the last byte being the predicted symbol) with its count in the
training texts.  A symbol's probability starts in the longest context that training has met and
escapes to shorter ones with PPM method D (a context with ``t`` counts of ``d`` distinct symbols gives
``(2c - 1) / 2t`` to a symbol met ``c`` times and ``d / 2t`` to the escape), each time excluding the symbols that the longer context holds; the last resort is uniform
over the symbols not excluded.  Symbols are the 254 bytes that UTF-8 text can hold plus the end of the
text; the start of a text is a context of its own.

Counts and probabilities are Spark joins and aggregations, nothing is sampled, pruned or broadcast:

1. Texts are dealt into blocks by hash.  A block returns its distinct grams and words with their
   training counts, packed by bucket of the key, so what is shuffled is a compressed vocabulary per block, not a row
   per byte or per gram.
2. Counts are summed per bucket; the shallower tables follow from the deepest by dropping the first
   byte.  Depth by depth, a gram's code length is derived from the next shallower table: since the
   symbols of a context are symbols of its suffix too, exclusion is one sum per context.
3. Code lengths go back, bucket by bucket, to the blocks that asked for them, and every text is scored beside its
   block's own tables.  A block holds about ``block_bytes`` of text; a longer text is worked on in slices.

Words are named by 64-bit hashes.  The text a model scores is its word sequence, A-Z lower-cased, words joined by one blank, and the end.
Memory: a task holds one block's texts or its distinct grams (16 bytes each) at a time, or one bucket's, which stands
for about ``bucket_bytes`` of text.

Defined cases: NULL text is empty; NULL and repeated ids get a row each; without training rows every symbol is uniform; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from seqweave.llm.common import LOWER, SPACES, U64, SpanHasher, chunks
from seqweave.plans.stage import stage_buckets, stage_table
from seqweave.session import ship_package

START, END = 0xFE, 0xFF  # bytes that UTF-8 never holds
SYMBOLS = 255  # 254 bytes and the end
SUB = 1_000_000  # characters worked on at a time
ROWS = 256  # texts taken out of a batch at a time
_BLANKS = re.compile(rb"[\x09-\x0d\x20]+")


class Symbols:
    """The symbols and words of some texts: ``grams`` (packed, one per symbol) with the texts' ``offsets``,
    ``words`` (64-bit hashes) with the index of their text in ``of``."""

    def __init__(self, texts: list[str], order: int):
        end = bytes([END])
        buf = LOWER[np.frombuffer(b"".join(t.encode() + end for t in texts), np.uint8)]
        ends = np.flatnonzero(buf == END)
        inside = ~SPACES[buf]
        inside[ends] = False
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
        first, last = edge[::2], edge[1::2]
        self.of = np.searchsorted(ends, first)
        self.words = SpanHasher(buf).spans(first, last)
        # one blank between two words of a text
        gap = last[:-1][self.of[1:] == self.of[:-1]]
        buf[gap] = 32
        inside[gap] = inside[ends] = True
        kept = np.flatnonzero(inside)
        text = np.searchsorted(ends, kept)
        place = np.arange(len(kept)) + order * (text + 1)
        padded = np.full(len(kept) + order * len(texts), START, np.uint8)
        padded[place] = buf[kept]
        self.grams = _grams(padded, place, order)
        self.offsets = np.searchsorted(text, np.arange(len(texts)))


def _grams(padded: np.ndarray, place: np.ndarray, order: int) -> np.ndarray:
    out = np.zeros(len(place), U64)
    for i in range(order + 1):
        out <<= U64(8)
        out |= padded[place - order + i]
    return out


class Slice:
    """Part of one long text, with the fields of ``Symbols`` (one text)."""

    def __init__(self, grams: np.ndarray, words: np.ndarray):
        self.grams, self.words = grams, words
        self.of, self.offsets = np.zeros(len(words), np.int64), np.zeros(1, np.int64)


def _word_name(word: bytes) -> int:
    if len(word) > 4 * SUB:  # such words are met here only
        return int.from_bytes(blake2b(word, digest_size=8).digest())
    buf = np.frombuffer(word, np.uint8)
    return int(SpanHasher(buf).spans(np.array([0]), np.array([len(buf)]))[0])


def _slices(text: str, order: int, size: int) -> Iterator[Slice]:
    """A long text, ``size`` symbols at a time."""
    data = _BLANKS.sub(b" ", text.encode().translate(LOWER.tobytes())).strip(b" ")
    stream = np.frombuffer(bytes([START] * order) + data + bytes([END]), np.uint8)
    word = 0  # where the word in progress starts in ``data``
    for s in range(0, len(data) + 1, size):
        e = min(s + size, len(data) + 1)
        grams = _grams(stream[s:e + order], np.arange(e - s) + order, order)
        stops = s + np.flatnonzero(np.isin(stream[s + order:e + order], (32, END)))
        names = np.empty(0, U64)
        if len(stops) and len(data):
            whole = np.frombuffer(data, np.uint8)[stops[0] + 1:stops[-1]] if len(stops) > 1 else np.empty(0, np.uint8)
            at = np.concatenate(([0], stops[1:-1] - stops[0], [len(whole) + 1])) if len(stops) > 1 else np.zeros(1, np.int64)
            inner = SpanHasher(whole).spans(at[:-1], at[1:] - 1) if len(stops) > 1 else np.empty(0, U64)
            names = np.concatenate((np.array([_word_name(data[word:stops[0]])], U64), inner))
            word = int(stops[-1]) + 1
        yield Slice(grams, names)


def symbol_groups(texts: list[str], order: int, size: int = SUB) -> Iterator[tuple[int, int, Symbols | Slice]]:
    """(first text, last + 1, symbols): several short texts together, a long one in slices."""
    for i, j in chunks(texts, size):
        if j == i + 1 and len(texts[i]) > size:
            for part in _slices(texts[i], order, size):
                yield i, j, part
        else:
            yield i, j, Symbols(texts[i:j], order)


GRAM, WORD = 0, 1
END_WORD = 1  # the name of the end among the word hashes
_VOCAB = "block long, kind int, bucket long, m int, keys binary, counts binary"
_ANSWER = "block long, kind int, m int, keys binary, vals binary, codes binary"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _arrow(columns: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def _pack(a: np.ndarray) -> bytes:
    """Compressed 8-byte values, byte planes apart."""
    return pa.compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, m: int, dtype) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * m, codec="zstd", asbytes=True), np.uint8).reshape(8, m)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences."""
    return _pack(np.diff(keys, prepend=U64(0)))


def _unpack_keys(data: bytes, m: int) -> np.ndarray:
    return np.cumsum(_unpack(data, m, U64), dtype=U64)


def _pack_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """The distinct values and, per entry, which of them (many grams have the same counts around them)."""
    distinct, code = np.unique(values, return_inverse=True)
    planes = np.ascontiguousarray(code.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return _pack(distinct), pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack_values(vals: bytes, codes: bytes, m: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(codes, 4 * m, codec="zstd", asbytes=True), np.uint8).reshape(4, m)
    code = np.ascontiguousarray(planes.T).reshape(-1).view("<u4")
    return _unpack(vals, int(code.max()) + 1, np.float64)[code]


def _merge(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal keys of several (keys, counts); keys ascending."""
    keys = np.concatenate([g for g, _ in parts])
    n = np.concatenate([n for _, n in parts])
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n, first)


def _vocabulary(order: int, buckets: int, size: int):
    """Group function: a block's texts -> its distinct grams and words with training counts."""
    schema = _arrow(_VOCAB)

    def packed(block: int, kind: int, some: list) -> pa.RecordBatch:
        keys, n = _merge(some)
        bucket = keys.view(np.int64) % buckets
        by_bucket = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
        rows = []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            at = by_bucket[edges[b]:edges[b + 1]]
            rows.append((block, kind, b, len(at), _pack_keys(keys[at]), _pack(n[at])))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = 0, {GRAM: [], WORD: []}
        for b in batches:
            block = b.column(0)[0].as_py()
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                texts, train = part.column(2).to_pylist(), part.column(1).to_pylist()
                for use in (True, False):
                    some = [t for t, w in zip(texts, train, strict=True) if w == use]
                    _add(parts, {WORD: np.full(len(some), END_WORD, U64)}, use)
                    for _, _, s in symbol_groups(some, order, size):
                        _add(parts, {GRAM: s.grams, WORD: s.words}, use)
        for kind, some in parts.items():
            yield packed(block, kind, some)
    return run


def _add(parts: dict[int, list], keys: dict[int, np.ndarray], use: bool) -> None:
    for kind, k in keys.items():
        if len(k):
            uniq, n = np.unique(k, return_counts=True)
            parts[kind].append((uniq, n if use else np.zeros(len(n), np.int64)))
            if len(parts[kind]) > 8:
                parts[kind] = [_merge(parts[kind])]


def _blobs(table: pa.Table) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(block, m, keys, counts) of a bucket's rows."""
    for b in table.to_batches(max_chunksize=256):
        yield from zip(*(b.column(c).to_pylist() for c in ("block", "m", "keys", "counts")), strict=True)


def _total(table: pa.Table) -> pa.Table:
    """Group function: a bucket of all blocks -> its keys with summed counts."""
    kind, parts = table.column("kind")[0].as_py(), []
    for _, m, keys, counts in _blobs(table):
        parts.append((_unpack_keys(keys, m), _unpack(counts, m, np.int64)))
        if sum(len(k) for k, _ in parts[1:]) > 1_000_000:
            parts = [_merge(parts)]
    keys, n = _merge(parts)
    return pa.table({"kind": pa.array(np.full(len(keys), kind, np.int32)), "key": pa.array(keys.view(np.int64)), "c": pa.array(n)})


def _answer(values: pa.Table, asked: pa.Table) -> pa.Table:
    """Cogroup function: a bucket's values and what each block has asked of it -> the values in the block's order."""
    schema = _arrow(_ANSWER)
    if not asked.num_rows:
        return schema.empty_table()
    kind = asked.column("kind")[0].as_py()
    key = values.column("key").to_numpy().view(U64)
    order = np.argsort(key)
    key, value = key[order], values.column("value").to_numpy()[order]
    rows = [(block, kind, m, keys, *_pack_values(value[np.searchsorted(key, _unpack_keys(keys, m))]))
            for block, m, keys, _ in _blobs(asked)]
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _deepest_first(grams: DataFrame, order: int) -> list[DataFrame]:
    """Node tables by depth, 0 to ``order``: ``gram, c``; each follows from the next deeper one."""
    nodes = [grams]
    for depth in range(order - 1, -1, -1):
        mask = (1 << (8 * (depth + 1))) - 1
        short = nodes[0].select(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram"), "c")
        nodes.insert(0, stage_table(short.groupBy("gram").agg(F.sum("c").alias("c")), f"ppm-nodes-{depth}"))
    return nodes


def code_lengths(grams: DataFrame, order: int) -> DataFrame:
    """``gram, bits10``: log10 of the symbol's probability after its context, for every gram of the
    table ``gram, c`` (grams of ``order`` + 1 bytes; c = 0 where training has not met it)."""
    nodes = _deepest_first(grams, order)
    zero = F.lit(0).cast("long")
    lower = None
    for depth, node in enumerate(nodes):
        context = F.shiftright("gram", 8)
        rows = node.withColumn("ctx", context)
        if lower is None:
            rows = rows.withColumn("cl", zero).withColumn("tl", zero).withColumn("dl", zero).withColumn(
                "el", F.lit(0.0)).withColumn("ql", F.lit(0.0))
        else:
            mask = (1 << (8 * depth)) - 1
            rows = rows.withColumn("suffix", F.col("gram").bitwiseAND(F.lit(mask))).join(lower, "suffix").drop("suffix")
        by = Window.partitionBy("ctx")  # at most 255 symbols
        met = F.col("c") > 0
        rows = rows.withColumn("t", F.sum("c").over(by)).withColumn("d", F.sum(met.cast("long")).over(by))
        # what the shorter context has counted for the symbols excluded there
        rows = rows.withColumn("x", F.sum(F.when(met, F.col("cl")).otherwise(0)).over(by))
        if depth == 0:
            after = -F.log10(F.lit(SYMBOLS) - F.least(F.col("d"), F.lit(SYMBOLS - 1)))
        else:
            left, fresh = F.col("tl") - F.col("x"), F.col("dl") - F.col("d")
            # (only read for symbols the context has not met; for the others it may be undefined)
            after = F.when(F.col("cl") > 0, F.log10(F.try_divide(2 * F.col("cl") - 1, 2 * left))).when(
                left > 0, F.log10(F.try_divide(fresh, 2 * left)) + F.col("el")).otherwise(F.col("el"))
        rows = rows.withColumn("e", after)  # the symbol's length after an escape from this context
        start = F.when(met, F.log10(F.try_divide(2 * F.col("c") - 1, 2 * F.col("t")))).when(
            F.col("t") > 0, F.log10(F.try_divide("d", 2 * F.col("t"))) + F.col("e")).otherwise(
            F.col("ql") if depth else F.col("e"))
        rows = rows.withColumn("q", start)
        if depth == order:
            return rows.select("gram", F.col("q").alias("bits10"))
        lower = stage_table(rows.select(F.col("gram").alias("suffix"), F.col("c").alias("cl"), F.col("t").alias("tl"),
                                        F.col("d").alias("dl"), F.col("e").alias("el"), F.col("q").alias("ql")),
                            f"ppm-depth-{depth}")


_SCORES = pa.schema([("_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("log_counts", pa.float64()), ("score", pa.float64())])


def _sorted(model: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's keys of one kind, ascending, and their values."""
    keys, values = [np.empty(0, U64)], [np.empty(0)]
    for b in model.to_batches():
        for k, m, packed, vals, codes in zip(*(b.column(c).to_pylist() for c in ("kind", "m", "keys", "vals", "codes")), strict=True):
            if k == kind:
                keys.append(_unpack_keys(packed, m))
                values.append(_unpack_values(vals, codes, m))
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key)
    return key[order], value[order]


def _score(order: int, out: pa.Schema, size: int):
    """Cogroup function: a block's texts and its tables -> scores."""
    def run(texts: pa.Table, model: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return out.empty_table()
        gram, bits = _sorted(model, GRAM)
        word, count = _sorted(model, WORD)
        at_end = count[np.searchsorted(word, U64(END_WORD))]
        parts = []
        for b in texts.select(["_text"]).to_batches(max_chunksize=ROWS):
            rows = b.column(0).to_pylist()
            n, known = np.ones(len(rows), np.int64), np.full(len(rows), at_end > 0, np.int64)
            logs, score = np.full(len(rows), np.log10(at_end + 0.5)), np.zeros(len(rows))
            for i, j, s in symbol_groups(rows, order, size):
                c = count[np.searchsorted(word, s.words)]
                n[i:j] += np.bincount(s.of, minlength=j - i)
                known[i:j] += np.bincount(s.of, c > 0, j - i).astype(np.int64)
                logs[i:j] += np.bincount(s.of, np.log10(c + 0.5), j - i)
                # looked up in ascending order: neighbours share the cache lines of the search
                distinct, place = np.unique(s.grams, return_inverse=True)
                score[i:j] += np.add.reduceat(bits[np.searchsorted(gram, distinct)][place], s.offsets)
            parts.append((n, known, logs, score))
        columns = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
        return pa.Table.from_arrays([texts.column("_id"), *columns], schema=out)
    return run


def _prime(n: int) -> int:
    """The first prime from ``n`` on."""
    while n < 2 or any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 5,
                block_bytes: int = 8_000_000, bucket_bytes: int = 8_000_000, slice_chars: int = SUB) -> DataFrame:
    """Per row: ``_id, n_tokens, n_known, train_tokens, base_score, score``.

    ``train`` marks the rows the model learns from (NULL: not).  ``base_score`` is the add-half unigram
    score of the tokens (the words and the end).  Without training rows every symbol is uniform.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = int(docs.select(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0)
    blocks, buckets = max(1, -(-size // block_bytes)), _prime(-(-size // bucket_bytes))
    # id and text together spread repeated ids and repeated texts alike
    src = docs.select(F.pmod(F.xxhash64(F.col(id_col).cast("string"), text), F.lit(blocks)).alias("block"),
                      F.coalesce(train, F.lit(False)).alias("_train"), F.col(id_col).alias("_id"), text.alias("_text"))
    src = stage_buckets(src, "ppm-texts", ["block"], blocks)
    vocab = src.select("block", "_train", "_text").groupBy("block").applyInArrow(_vocabulary(order, buckets, slice_chars), _VOCAB)
    vocab = stage_buckets(vocab, "ppm-vocabulary", ["kind", "bucket"], buckets)
    totals, seen = stage_table(vocab.groupBy("kind", "bucket").applyInArrow(_total, "kind int, key long, c long"), "ppm-totals", {
        "n": F.sum(F.when(F.col("kind") == WORD, F.col("c"))),
        "v": F.sum(((F.col("kind") == WORD) & (F.col("c") > 0)).cast("long"))})
    n, v = int(seen["n"] or 0), int(seen["v"] or 0)
    lengths = code_lengths(totals.filter(F.col("kind") == GRAM).select(F.col("key").alias("gram"), "c"), order)
    values = lengths.select(F.lit(GRAM).alias("kind"), F.col("gram").alias("key"), F.col("bits10").alias("value")).unionByName(
        totals.filter(F.col("kind") == WORD).select("kind", "key", F.col("c").cast("double").alias("value")))
    values = values.withColumn("bucket", F.pmod("key", F.lit(buckets).cast("long")))
    answers = values.groupBy("kind", "bucket").cogroup(vocab.groupBy("kind", "bucket")).applyInArrow(_answer, _ANSWER)
    kind = dict(src.dtypes)["_id"]
    out = _SCORES.set(0, pa.field("_id", to_arrow_type(src.schema["_id"].dataType)))
    scored = src.select("block", "_id", "_text").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(order, out, slice_chars), f"_id {kind}, n_tokens long, n_known long, log_counts double, score double")
    return scored.select("_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         (F.col("log_counts") - F.col("n_tokens") * F.lit(float(np.log10(n + 0.5 * (v + 1))))).alias("base_score"),
                         "score")
