"""Importance resampling towards a target distribution.

1. Texts are lower-cased (A-Z) and split into words; a feature is a run of 1 to ``max_n`` words, hashed into one
   of ``buckets`` counters.  Tasks add features to one counter array each, Spark sums the arrays per bucket.
2. A bucket's gain is the scaled log ratio of its smoothed share in the target and in the source.  The gains
   are one array of ``buckets`` numbers, the only thing sent to the tasks besides the texts; a document's weight is
   the floored mean gain of its features, its score the weight plus Gumbel noise that depends on its id alone.
3. The winners, a share of the documents long enough, are those with the highest scores.  The least
   winner is found by a distributed quickselect over composite keys (score down, id, features, row): random
   rows of the open interval are its pivots, one aggregation counts exactly the rows below and up to each pivot,
   and the interval narrows to the part that holds the k-th key, until that key is a pivot.
4. Only the winners are sorted, by range, and ranked by their place behind the rows of earlier ranges.

Defined cases: NULL text has no words.  A NULL id scores like the empty id and comes after all ids in a tie.  Rows that
agree in score and id are drawn fewer features first, rows that agree in that too in any order (they are
alike).  An empty table gives an empty result; without target texts, all targets count 0.
A text is worked on in slices that end between words, so a long text holds no list of all its words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqweave.llm.common import id_text
from seqweave.plans.stage import stage_table
from seqweave.session import ship_package

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
SLICE = 1 << 20  # bytes of a text worked on at a time


def word_slices(text: str, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text in order, some at a time."""
    data = text.encode().translate(_LOWER)
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + size) if at + size < len(data) else None
        end = gap.start() if gap else len(data)
        yield _WORD.findall(data, at, end)
        at = end


def feature_buckets(text: str, max_n: int, buckets: int, size: int = SLICE) -> Iterator[tuple[int, np.ndarray]]:
    """Per slice of the text: its number of words and the buckets of the features that end in it."""
    carry: list[int | None] = [None] * max_n  # per run length the crc of the run that ends at the last word seen
    for words in word_slices(text, size):
        if not words:
            continue
        runs = list(map(crc32, words))
        found = list(runs)
        spaced = [b" " + w for w in words] if max_n > 1 else []
        last, carry[0] = carry[0], runs[-1]
        for k in range(1, max_n):
            # a run of k + 1 words continues the run of k words that ends one word earlier
            before = runs[:-1] if last is None else [last, *runs[:-1]]
            runs = list(map(crc32, spaced[len(spaced) - len(before):], before))
            found += runs
            last, carry[k] = carry[k], runs[-1] if runs else None
        yield len(words), np.array(found, np.uint32) % np.uint32(buckets)


def bucket_counts(texts: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """``bucket, n`` over all texts of the one column."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for text in b.column(0):
                for _, found in feature_buckets(text.as_py(), max_n, buckets):
                    np.add.at(total, found, 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])
    return texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains_of(source: dict[int, int], target: dict[int, int], buckets: int, scale: int = 1000) -> np.ndarray:
    """Per bucket ``floor(scale * ln(share in the target / share in the source))``, shares smoothed by one."""
    s_all, t_all = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([math.floor(scale * math.log(
        (target.get(b, 0) + 1.0) * s_all / ((source.get(b, 0) + 1.0) * t_all))) for b in range(buckets)], np.int64)


def weigh(rows: DataFrame, gains: np.ndarray, max_n: int) -> DataFrame:
    """``_id, n_words, n_features, weight`` per row of ``_id, _text``."""
    def run(batches):
        for b in batches:
            out = []
            for text in b.column(1):
                n_words = n = total = 0
                for w, found in feature_buckets(text.as_py(), max_n, len(gains)):
                    n_words += w
                    n += len(found)
                    total += int(gains[found].sum())
                out.append((n_words, n, total // n if n else 0))
            cols = np.array(out, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, cols)],
                                             names=["_id", "n_words", "n_features", "weight"])
    kind = dict(rows.dtypes)["_id"]
    return rows.mapInArrow(run, f"_id {kind}, n_words long, n_features long, weight long")


def gumbel(id_col, seed: int, scale: int = 1000):
    """Scaled and floored Gumbel noise from the first 8 hex digits of sha256(``seed:id``)."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


KEY = ["_down", "_none", "_id", "n_features", "_row"]  # the composite key, ascending


def _key_of(values: tuple, kinds: dict):
    return F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(KEY, values, strict=True)])


def kth_key(keys: DataFrame, k: int, pivots: int = 24, seed: int = 7) -> tuple:
    """The ``k``-th smallest composite key (from 1) of ``keys``, whose keys differ by ``_row``.

    Each round reads the narrow key table twice: for ``pivots`` random rows of the open interval, and for
    the exact numbers of rows below and up to each; about log(rows) / log(pivots) rounds.
    """
    kinds = dict(keys.dtypes)
    key = F.struct(*KEY)
    low = high = None
    below = 0  # rows up to ``low``
    for turn in range(10_000):
        active = keys
        if low is not None:  # the plain comparison prunes row groups
            active = active.filter((F.col("_down") >= low[0]) & (key > _key_of(low, kinds)))
        if high is not None:
            active = active.filter((F.col("_down") <= high[0]) & (key < _key_of(high, kinds)))
        picked = active.select(*KEY).orderBy(F.xxhash64(F.lit(seed + turn), "_row"), "_row").limit(pivots).collect()
        points = sorted(tuple(r) for r in picked)
        tests = [F.count_if(key <= _key_of(p, kinds)).alias(f"u{i}") for i, p in enumerate(points)]
        tests += [F.count_if(key < _key_of(p, kinds)).alias(f"b{i}") for i, p in enumerate(points)]
        seen = active.agg(*tests).first()
        up_to, under = seen[:len(points)], seen[len(points):]
        at = next((i for i, n in enumerate(up_to) if below + n >= k), None)
        if at is not None and below + under[at] < k:
            return points[at]
        if at is None or at > 0:
            low, below = (points[-1], below + up_to[-1]) if at is None else (points[at - 1], below + up_to[at - 1])
        if at is not None:
            high = points[at]
    raise RuntimeError("quickselect did not settle")


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with ``rank`` by composite key: sorted in ranges, ranked behind the rows of earlier ranges."""
    spark = winners.sparkSession
    # the id numbers the rows of each sorted range: range number and place in it
    placed = winners.repartitionByRange(*KEY).sortWithinPartitions(*KEY).withColumn("_at", F.monotonically_increasing_id())
    placed = stage_table(placed, "resampled")
    part = F.shiftright("_at", 33)
    sizes = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, rows = 0, []
    for p in sorted(sizes):  # one row per range
        rows.append((p, before))
        before += sizes[p]
    offsets = spark.createDataFrame(rows, "_part long, _before long")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(
        "rank", F.col("_before") + place + 1).drop("_at", "_part", "_before")


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (25, 100), min_words: int = 20,
             max_n: int = 2, buckets: int = 10_000, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``_id, n_words, n_features, weight, score, rank`` (NULL where not drawn).

    Of the N rows with ``min_words`` words or more, ``floor(share * N)`` are drawn.
    """
    ship_package(docs.sparkSession)
    rows = id_text(docs, id_col, text_col)
    wanted = target.select(F.coalesce(F.col(target_text), F.lit("")).alias("_text"))
    counted = [{r["bucket"]: r["n"] for r in bucket_counts(t, max_n, buckets).collect()}  # at most ``buckets`` rows
               for t in (rows.select("_text"), wanted)]
    weighed = weigh(rows, gains_of(*counted, buckets), max_n)
    score = F.col("weight") + gumbel(F.col("_id"), seed)
    scored = weighed.withColumn("score", score).select(
        "*", (-F.col("score")).alias("_down"), F.col("_id").isNull().alias("_none"),
        F.monotonically_increasing_id().alias("_row"))
    fits = F.col("n_words") >= min_words
    scored, seen = stage_table(scored, "importance", {"n": F.sum(fits.cast("long"))})
    k = share[0] * int(seen["n"] or 0) // share[1]
    out = ["_id", "n_words", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if k == 0:
        return scored.select(*out, unranked)
    able = scored.filter(fits)
    last = _key_of(kth_key(able.select(*KEY), k), dict(scored.dtypes))
    drawn = fits & (F.struct(*KEY) <= last)
    return ranked(scored.filter(drawn)).select(*out, "rank").unionByName(scored.filter(~drawn).select(*out, unranked))
