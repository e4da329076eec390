"""Small helpers shared by the operators of this folder.

Conventions that hold for every operator here:

* Only the id and text columns named by the caller are read, so extra columns
  (whatever their names) never clash with the operator's own.
* NULL text counts as the empty text.  A NULL id is a value like any other
  (joins on ids are null-safe).
* Repeated rows each get their own result row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
_RADIX = 0x9E3779B97F4A7C15 | 1
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under its own names ``_id`` and ``_text``."""
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (a NULL id is in fold 0)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds, F.lit(0))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII text takes the fast built-in."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


HEAVY_KEYS = 10_000


def join_heads(rows: DataFrame, heads: DataFrame, key: str, n_rows: int) -> DataFrame:
    """Inner join of ``rows`` with one head per key, where a few keys may hold most rows.

    ``heads`` has ``key``, ``_n`` (its number of rows; dropped) and more columns.  Keys with more than 1 in
    ``HEAVY_KEYS`` of the ``n_rows`` rows, so at most ``HEAVY_KEYS`` of them, are broadcast and their rows stay where they
    are; the others meet by shuffle, none of them in bulk.  ``rows`` is read twice: stage it first.
    """
    light = max(1000, n_rows // HEAVY_KEYS)
    few = F.broadcast(heads.filter(F.col("_n") > light))
    hot = rows.join(few, key).drop("_n")
    cold = rows.join(few.select(key), key, "left_anti").join(heads.filter(F.col("_n") <= light), key).drop("_n")
    return hot.unionByName(cold)


def chunks(texts: list, limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of about ``limit`` characters (a longer text is alone in its range)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


class SpanHasher:
    """64-bit hashes of many byte ranges of one buffer from a running polynomial sum.

    ``H[i] = sum_{j<i} T[b_j] * r^j`` (mod 2^64, r odd); a range's hash is
    ``(H[end] - H[start]) * r^-start``, so equal bytes hash equally wherever
    they stand.  ``T`` is a fixed random table, ``seed`` picks another one.
    """

    _powers: dict = {}

    def __init__(self, buf: np.ndarray, seed: int = 1):
        n = len(buf)
        r = (_RADIX + 2 * 0x632BE59BD9B4E019 * seed) % 2**64 | 1
        up, down = self._tables(r, n)
        values = np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(values[buf] * up[:n], out=self.sums[1:])
        self.down = down

    @classmethod
    def _tables(cls, r: int, n: int):
        have = cls._powers.get(r)
        if have is None or len(have[0]) < n + 1:
            size = max(n + 1, 1 << 16)
            both = []
            for base in (r, pow(r, -1, 2**64)):
                p = np.full(size, base, U64)
                p[0] = 1
                both.append(np.cumprod(p))
            cls._powers[r] = have = tuple(both)
        return have

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def words_of(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the runs of non-space bytes."""
    inside = np.concatenate(([False], ~SPACES[buf], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def lower_bytes(text: str) -> np.ndarray:
    return LOWER[np.frombuffer(text.encode(), np.uint8)]


def shingles(text: str, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles (A-Z lower-cased, words split at spaces).

    A text of fewer words, but not none, has one shingle: all its words.
    """
    buf = lower_bytes(text)
    s, e = words_of(buf)
    if not len(s):
        return np.empty(0, U64)
    w = SpanHasher(buf).spans(s, e)
    k = min(size, len(w))
    h = np.zeros(len(w) - k + 1, U64)
    for j in range(k):
        h = mix(h * U64(31) + w[j:len(w) - k + 1 + j] + U64(j + 1))
    return np.unique(h)
