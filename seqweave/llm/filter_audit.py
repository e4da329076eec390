"""How five filters interact: what each removes at each step of each of the 120 orders.

1. One pass over the texts gives every row its failures of the text filters as a bit mask and a digest of the text.
2. A row fails the copy filter if the same text stands at a smaller id anywhere in the table.  Rows with equal
   text, id and marks are counted first, then per text and marks the least id and its rows; only these few rows of a
   text meet, so a text with many copies is never in one task.
3. What is left are counts per part and mask, at most 32 masks and their label counts: a part's whole
   audit follows from them.  The orders stand in lexicographic order, numbered by Lehmer rank.  The orders in which mask m is
   removed at step s are those that start with s - 1 filters outside m and then one of m; orders with one
   such start are neighbours, an interval of (5 - s)! ranks.  So a mask adds its counts at the first rank of each interval
   and takes them away behind the last, and a prefix sum over the 120 ranks gives the removals of every step.

Filters (fixed values, see ``FILTERS``) act on whole texts.  Defined cases: NULL text is empty (and fails A only, B to D as
the inequalities say, E if it is repeated); NULL part values count as the empty part name; NULL ids come after
all ids and are not smaller than each other; of rows with the same id and text none makes the other a copy.  Several label rows
of an id count as marked if one of them is; label rows of no document and with NULL ids are not used.
An empty table has no parts and no rows.
"""

from __future__ import annotations

import itertools
import math
import re
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqweave.plans.stage import stage_table
from seqweave.session import ship_package

FILTERS = "ABCDE"
UPPER = bytes(range(65, 91))
MARKS = b"#$%&*|"
FEW_WORDS = 100
COPY = 1 << FILTERS.index("E")
_SPACE = re.compile(rb"[\x09-\x0d\x20]")
SLICE = 4 << 20  # bytes of a text worked on at a time


# --------------------------------------------------------------------------- one text
def word_counts(data: bytes, size: int = SLICE) -> tuple[int, int]:
    """Words and distinct words; of a text longer than a slice, distinct words are told apart by 64-bit hashes."""
    if len(data) <= size:
        words = data.split()
        return len(words), len(set(words))
    total, at = 0, 0
    seen = np.empty(0, np.uint64)
    while at < len(data):
        gap = _SPACE.search(data, at + size) if at + size < len(data) else None
        end = gap.start() if gap else len(data)
        words = data[at:end].split()
        total += len(words)
        seen = np.union1d(seen, np.fromiter((xxhash.xxh3_64_intdigest(w) for w in set(words)), np.uint64))
        at = end
    return total, len(seen)


def failures(text: str, size: int = SLICE) -> int:
    """Bit mask of the failed text filters (A to D)."""
    data = text.encode()
    words, distinct = word_counts(data, size)
    capitals = len(data) - len(data.translate(None, UPPER))
    fails = (words < FEW_WORDS, 100 * distinct < 80 * words, 100 * capitals > 10 * len(text),
             len(data.translate(None, MARKS)) < len(data))
    return sum(1 << i for i, bad in enumerate(fails) if bad)


def _masks(rows: DataFrame) -> DataFrame:
    """``_id, part, text_key, mask`` per row of ``_id, part, _text``."""
    def run(batches):
        for b in batches:
            keys, masks = [], []
            for text in b.column(2):
                text = text.as_py()
                keys.append(blake2b(text.encode(), digest_size=16).digest())
                masks.append(failures(text))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(masks, pa.int32())],
                                             names=["_id", "part", "text_key", "mask"])
    kind = dict(rows.dtypes)["_id"]
    return rows.mapInArrow(run, f"_id {kind}, part string, text_key binary, mask int")


# --------------------------------------------------------------------------- counts
def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                label_id: str = "doc_id", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """``part, mask, n, good, toxic``: rows, rows labelled good and rows labelled toxic, by part and failed filters."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    marks = labels.filter(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("_lid")).agg(
        F.max((F.col(good_col) == 1).cast("int")).alias("good"), F.max((F.col(toxic_col) == 1).cast("int")).alias("toxic"))
    one = ["_id", "part", "text_key", "mask"]
    same = _masks(rows).groupBy(*one).agg(F.count(F.lit(1)).alias("n"))
    known = same.join(marks, F.col("_id") == F.col("_lid"), "left").select(
        *one, "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    # per text and marks: all rows, the least id and the rows that have it
    kind = ["text_key", "part", "mask", "good", "toxic"]
    least = F.min(F.struct(F.col("_id").isNull(), "_id", "n"))
    groups = known.groupBy(*kind).agg(F.sum("n").alias("n"), least.alias("_least"))
    groups = groups.select(*kind, "n", F.struct(F.col("_least.col1").alias("none"), F.col("_least._id").alias("id")).alias("_at"),
                           F.col("_least.n").alias("_own"))
    first = F.min("_at").over(Window.partitionBy("text_key"))
    kept = F.when(F.col("_at") == first, F.col("_own")).otherwise(F.lit(0))
    groups = groups.withColumn("kept", kept)
    parts = groups.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask"), F.col("kept").alias("n")),
        F.struct((F.col("mask") + COPY).alias("mask"), (F.col("n") - F.col("kept")).alias("n")))).alias("_m"))
    return parts.groupBy("part", F.col("_m.mask").alias("mask")).agg(
        F.sum("_m.n").alias("n"), F.sum(F.col("_m.n") * F.col("good")).alias("good"),
        F.sum(F.col("_m.n") * F.col("toxic")).alias("toxic"))


# --------------------------------------------------------------------------- orders
@lru_cache(1)
def orders() -> np.ndarray:
    """All orders, rank by rank, as filter numbers."""
    return np.array(list(itertools.permutations(range(len(FILTERS)))))


def lehmer_rank(start: tuple[int, ...]) -> int:
    """Rank of the first order that begins with ``start``."""
    rank = 0
    for i, f in enumerate(start):
        smaller = sum(g < f for g in range(len(FILTERS)) if g not in start[:i])
        rank += smaller * math.factorial(len(FILTERS) - 1 - i)
    return rank


@lru_cache(1 << len(FILTERS))
def intervals(mask: int) -> list[tuple[int, int, int]]:
    """(step, first rank, rank behind the last) of the runs of orders in which ``mask`` is removed at that step."""
    fails = [f for f in range(len(FILTERS)) if mask >> f & 1]
    passes = [f for f in range(len(FILTERS)) if not mask >> f & 1]
    out = []
    for step in range(len(passes) + 1 if fails else 0):
        width = math.factorial(len(FILTERS) - 1 - step)
        for before in itertools.permutations(passes, step):
            for f in fails:
                low = lehmer_rank((*before, f))
                out.append((step, low, low + width))
    return out


def removals(masks: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``[count, step, rank]``: rows removed at each step of each order, for each column of ``counts``."""
    n_orders = math.factorial(len(FILTERS))
    edges = np.zeros((counts.shape[1], len(FILTERS), n_orders + 1), np.int64)
    for mask, row in zip(masks.tolist(), counts, strict=True):
        for step, low, high in intervals(mask):
            edges[:, step, low] += row
            edges[:, step, high] -= row
    return edges.cumsum(axis=2)[:, :, :n_orders]


def audit_part(masks: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """The audit's columns, rank by rank and step by step (``counts``: rows, good rows, toxic rows per mask)."""
    gone = removals(masks, counts).transpose(0, 2, 1)  # count, rank, step
    order = orders()
    bits = masks[:, None] >> np.arange(len(FILTERS))[None, :] & 1
    failing = (bits * counts[:, :1]).sum(axis=0)
    alone = np.array([counts[masks == 1 << f, 0].sum() for f in range(len(FILTERS))])
    shapley = np.bincount(order.ravel(), gone[0].ravel(), len(FILTERS)).astype(np.int64)
    removed = gone[0]
    return {"filter_order": np.repeat(["".join(FILTERS[f] for f in o) for o in order], len(FILTERS)),
            "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(order)),
            "kept": (counts[:, 0].sum() - removed.cumsum(axis=1)).ravel(), "removed": removed.ravel(),
            "redundant": (failing[order] - removed).ravel(), "unique_fails": alone[order].ravel(),
            "good_lost": gone[1].ravel(), "toxic_lost": gone[2].ravel(), "shapley": shapley[order].ravel()}


def filter_audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    counts = stage_table(mask_counts(docs, labels, **columns), "mask-counts")

    def audit(table: pa.Table) -> pa.Table:
        numbers = np.array([table.column(c).to_numpy() for c in ("n", "good", "toxic")], np.int64).T
        out = audit_part(table.column("mask").to_numpy().astype(np.int64), numbers)
        part = pa.array([table.column("part")[0].as_py()] * len(out["step"]), pa.string())
        return pa.table({"part": part, **{k: pa.array(v) for k, v in out.items()}})

    longs = ", ".join(f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    return counts.groupBy("part").applyInArrow(audit, f"part string, filter_order string, step int, {longs}")
