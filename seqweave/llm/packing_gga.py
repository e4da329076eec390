"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

1. Every document is encoded once; ids plus the end id are cut into pieces of
   at most ``capacity`` tokens (only the first piece of a longer document is
   shorter).  The narrow piece table (id, piece, start, length, crc) is staged.
2. Pieces of equal length are interchangeable, so a packing of the whole table is a list of patterns (the
   lengths in a bin) with the number of bins that have each: it is as large as the variety of lengths, at most
   ``capacity``, whatever the table's size.  The search works on such packings.
3. Islands, a task each, evolve a population of packings of the whole table, all of it fitted: the first by
   best-fit decreasing, the others in disturbed orders.  A child takes whole well-filled bins of one parent, then the bins of
   the other parent as far as their pieces are left, and the displaced pieces go back best-fit, the
   longest first.  After each epoch an island's best packing migrates to the next island of the ring.
4. The best packing of all islands is carried out: a piece's number among the pieces of its length picks
   the bin and the offset by arithmetic.

As best-fit decreasing is in every first population and the best packing is never lost, the result has at most as many
bins as best-fit decreasing of the whole table, however the table is partitioned.

Defined cases: NULL text is empty (one piece, the end id); rows with equal ids or equal rows are packed one by one; which
of several pieces of equal length goes where depends on their order in the table, the number of bins does not.
An empty table gives no rows.
"""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqweave.llm.bpe import PRE_TOKEN, encode, encoding
from seqweave.llm.common import chunks, id_text
from seqweave.plans.stage import stage_table
from seqweave.session import ship_package


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n_tokens`` tokens."""
    if n_tokens <= capacity:
        return [(0, n_tokens)]
    first = n_tokens % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n_tokens, capacity)]


def document_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
                    id_col: str = "doc_id", text_col: str = "text", pattern: str = PRE_TOKEN,
                    added: bool = False) -> DataFrame:
    """``_id, _row, piece, start, length, ids_crc32`` (``_row`` tells repeated ids apart by text;
    ``added``: see ``bpe``)."""
    ship_package(docs.sparkSession)
    src = id_text(docs, id_col, text_col).select("_id", F.xxhash64("_text").alias("_row"), "_text")

    def run(batches):
        enc = encoding(tokenizer_path, pattern, added)
        end = np.asarray([end_id], "<u4").tobytes()
        for b in batches:
            texts = b.column(2).to_pylist()
            for i, j in chunks(texts, 4_000_000):
                at, piece, start, length, crc = [], [], [], [], []
                for k in range(i, j):
                    data = encode(enc, texts[k]) + end
                    for p, (s, n) in enumerate(cut(len(data) // 4, capacity)):
                        at.append(k)
                        piece.append(p)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(memoryview(data)[4 * s:4 * (s + n)]))
                at = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["_id", "_row", "piece", "start", "length", "ids_crc32"])

    kind = dict(src.dtypes)["_id"]
    return src.mapInArrow(run, f"_id {kind}, _row long, piece int, start long, length long, ids_crc32 long")


# ------------------------------------------------------------------ packings of a histogram
Pattern = tuple[int, ...]  # the lengths in a bin, longest first
WELL_FILLED = 0.985  # share of the capacity


class Packing:
    """Bins by pattern: ``bins[pattern]`` of them hold the lengths of the pattern."""

    def __init__(self, capacity: int, bins: dict[Pattern, int] | None = None):
        self.capacity = capacity
        self.bins = dict(bins or {})

    def __len__(self) -> int:
        return sum(self.bins.values())

    def fitness(self) -> tuple[int, int]:
        """Fewer bins first, then fuller ones (sum of squared fills)."""
        return -len(self), sum(n * sum(p) ** 2 for p, n in self.bins.items())

    def lengths(self) -> dict[int, int]:
        """Pieces of each length."""
        out: dict[int, int] = {}
        for p, n in self.bins.items():
            for s in p:
                out[s] = out.get(s, 0) + n
        return out

    def best_fit(self, order: list[tuple[int, int]]) -> Packing:
        """Put ``n`` pieces of length ``s`` for each (s, n) of ``order``, each piece into the fullest bin that takes it."""
        at: list[list[list]] = [[] for _ in range(self.capacity + 1)]  # by free space: [pattern, bins]
        mask = 0
        for p in sorted(self.bins):
            free = self.capacity - sum(p)
            at[free].append([p, self.bins[p]])
            mask |= 1 << free

        def put(p: Pattern, times: int, bins: int, s: int) -> None:
            nonlocal mask
            new = tuple(sorted((*p, *[s] * times), reverse=True))
            free = self.capacity - sum(new)
            at[free].append([new, bins])
            mask |= 1 << free

        for s, n in order:
            while n:
                fits = mask >> s
                free = s + (fits & -fits).bit_length() - 1 if fits else self.capacity
                # a bin that has taken one piece is the fullest for the next, as long as it takes it
                each = free // s
                group = at[free][-1] if fits else [(), -(-n // each)]
                full = min(group[1], n // each)
                if full:
                    put(group[0], each, full, s)
                rest, n = min(n - full * each, each - 1) if full < group[1] else 0, n - full * each
                if rest:
                    put(group[0], rest, 1, s)
                    n -= rest
                group[1] -= full + (rest > 0)
                if fits and not group[1]:
                    at[free].remove(group)
                    if not at[free]:
                        mask &= ~(1 << free)
        self.bins = {}
        for groups in at:
            for p, bins in groups:
                if p and bins:
                    self.bins[p] = self.bins.get(p, 0) + bins
        return self


def best_fit_decreasing(lengths: dict[int, int], capacity: int) -> Packing:
    return Packing(capacity).best_fit(sorted(lengths.items(), reverse=True))


def least_bins(lengths: dict[int, int], capacity: int) -> int:
    """A lower bound: by tokens, and with the pieces that can share no bin counted whole."""
    total = sum(s * n for s, n in lengths.items())
    best = -(-total // capacity)
    for k in sorted({s for s in lengths if 2 * s <= capacity} | {1}):
        # pieces above capacity - k are alone among pieces of k or more; those above half are one a bin
        alone = sum(n for s, n in lengths.items() if s > capacity - k)
        half = {s: n for s, n in lengths.items() if capacity // 2 < s <= capacity - k}
        small = sum(s * n for s, n in lengths.items() if k <= s <= capacity // 2)
        space = sum(n * (capacity - s) for s, n in half.items())
        best = max(best, alone + sum(half.values()) + max(0, -(-(small - space) // capacity)))
    return best


def crossover(a: Packing, b: Packing, rng: random.Random) -> Packing:
    """Child of ``b`` with whole well-filled bins of ``a`` injected."""
    left = b.lengths()
    child: dict[Pattern, int] = {}

    def take(p: Pattern, wanted: int) -> None:
        """As many bins of pattern ``p`` as the pieces left allow."""
        need: dict[int, int] = {}
        for s in p:
            need[s] = need.get(s, 0) + 1
        n = min([wanted, *(left.get(s, 0) // m for s, m in need.items())])
        if n > 0:
            child[p] = child.get(p, 0) + n
            for s, m in need.items():
                left[s] -= n * m

    good = sorted(sorted(a.bins), key=lambda p: (-sum(p), rng.random()))
    well = [p for p in good if sum(p) >= WELL_FILLED * a.capacity] or good[:max(1, len(good) // 4)]
    share = rng.choice((0.5, 0.8, 1))
    for p in well:
        if rng.random() < share:
            take(p, a.bins[p])
    # bins of the other parent that share no piece with those stay whole; half-filled ones are often dissolved too
    for p in sorted(sorted(b.bins), key=lambda p: (-sum(p), rng.random())):
        if rng.random() < (0.97 if sum(p) >= WELL_FILLED * b.capacity else 0.6):
            take(p, b.bins[p])
    noise = rng.choice((0, 0, 0.1, 0.5))
    displaced = sorted(((s, n) for s, n in sorted(left.items()) if n), key=lambda x: -x[0] * (1 + noise * rng.random()))
    return Packing(a.capacity, child).best_fit(displaced)


def evolve(lengths: dict[int, int], capacity: int, seed: int, people: list[Packing], population: int = 8,
           generations: int = 100) -> list[Packing]:
    """The population after some generations, best first; stops at the lower bound."""
    rng = random.Random(seed)
    lengths = dict(sorted(lengths.items()))  # results do not depend on the order in which rows arrive
    bound = least_bins(lengths, capacity)
    people = list(people)
    if not people:
        people.append(best_fit_decreasing(lengths, capacity))
    noise = 0.02
    while len(people) < population and len(max(people, key=Packing.fitness)) > bound:
        order = sorted(lengths.items(), key=lambda x: -x[0] * (1 + noise * rng.random()))
        people.append(Packing(capacity).best_fit(order))
        noise += 0.03
    for _ in range(generations):
        people.sort(key=Packing.fitness, reverse=True)
        if len(people[0]) <= bound or len(people) < 2:
            break
        a, b = rng.choice(people[:3]), rng.choice(people)
        child = crossover(a, b, rng)
        if child.fitness() > people[-1].fitness() and all(child.bins != p.bins for p in people):
            people[-1] = child
    return sorted(people, key=Packing.fitness, reverse=True)[:population]


# ------------------------------------------------------------------ islands on Spark
_STATE = "island int, person int, pattern array<int>, bins long"
_SCHEMA = pa.schema([("island", pa.int32()), ("person", pa.int32()), ("pattern", pa.list_(pa.int32())), ("bins", pa.int64())])


def _island_step(capacity: int, islands: int, epoch: int, population: int, generations: int):
    """Group function: an island's packings in (or, as person -1, the histogram), its next population and a copy
    of the best for the next island out."""
    def step(table: pa.Table) -> pa.Table:
        island = table.column("island")[0].as_py()
        packings: dict[int, dict[Pattern, int]] = {}
        for who, p, n in zip(*(table.column(c).to_pylist() for c in ("person", "pattern", "bins")), strict=True):
            packings.setdefault(who, {})[tuple(p)] = n
        one = Packing(capacity, next(iter(packings.values())))
        people = [Packing(capacity, bins) for who, bins in sorted(packings.items()) if who >= 0]
        people = evolve(one.lengths(), capacity, 1000 * epoch + island, people, population, generations)
        rows = [(island, k, p, n) for k, x in enumerate(people) for p, n in sorted(x.bins.items())]
        rows += [((island + 1) % islands, population + island, p, n) for p, n in sorted(people[0].bins.items())]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
    return step


def search(lengths: DataFrame, capacity: int, islands: int = 8, epochs: int = 3, population: int = 8,
           generations: int = 100) -> dict[Pattern, int]:
    """The best packing found of the histogram ``length, n`` (at most ``capacity`` rows)."""
    spark = lengths.sparkSession
    state = lengths.select(F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.lit(-1).alias("person"),
                           F.array(F.col("length").cast("int")).alias("pattern"), F.col("n").alias("bins"))
    for epoch in range(epochs):
        step = _island_step(capacity, islands, epoch, population, generations)
        state = stage_table(state.groupBy("island").applyInArrow(step, _STATE), f"islands-{epoch}")
    sizes = state.groupBy("island", "person").agg(F.sum("bins").alias("n")).orderBy("n", "island", "person")
    best = sizes.first()
    if best is None:
        return {}
    chosen = state.filter((F.col("island") == best["island"]) & (F.col("person") == best["person"]))
    return {tuple(r["pattern"]): r["bins"] for r in chosen.collect()}  # a row per pattern, bounded by the capacity


class Places:
    """Where the pieces of each length go: runs of piece numbers by pattern."""

    def __init__(self, bins: dict[Pattern, int]):
        runs: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        base = 0
        for p, n in sorted(bins.items(), reverse=True):
            offset = 0
            for s in sorted(set(p), reverse=True):
                m = p.count(s)
                runs.setdefault(s, []).append((used.get(s, 0), m, base, offset))
                used[s] = used.get(s, 0) + m * n
                offset += m * s
            base += n
        self.runs = {s: np.array(r, np.int64).T for s, r in runs.items()}

    def of(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bin, offset) of pieces by length and number among the pieces of that length."""
        bins, offsets = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for s in np.unique(length).tolist():
            at = np.flatnonzero(length == s)
            first, m, base, offset = self.runs[s]
            k = np.searchsorted(first, number[at], "right") - 1
            place = number[at] - first[k]
            bins[at] = base[k] + place // m[k]
            offsets[at] = offset[k] + place % m[k] * s
        return bins, offsets


def pack(pieces: DataFrame, capacity: int = 1024, **options) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a piece table (``_id, _row, piece, start, length, ids_crc32``).

    Offsets are gapless from 0 in every sequence.  ``options`` go to ``search``.
    """
    ship_package(pieces.sparkSession)
    cols = ["_id", "_row", "piece", "start", "length", "ids_crc32"]
    # rows are numbered by writing task and place
    part = stage_table(pieces.select(*cols, F.monotonically_increasing_id().alias("_at")), "pieces")
    part = part.withColumn("_task", F.shiftright("_at", 33))
    counts = stage_table(part.groupBy("_task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    places = Places(search(counts.groupBy("length").agg(F.sum("n").alias("n")), capacity, **options))
    # a piece's number: those of its length in earlier tasks, then its place in its own
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    own = Window.partitionBy("_task", "length").orderBy("_at")
    numbered = part.withColumn("_own", F.row_number().over(own)).join(first, ["_task", "length"]).select(
        *cols, (F.col("_first") + F.col("_own") - 1).alias("_number"))

    def place(batches):
        for b in batches:
            seq, off = places.of(b.column("length").to_numpy(), b.column("_number").to_numpy())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in cols), pa.array(seq), pa.array(off)],
                                             names=[*cols, "sequence_id", "offset"])

    kinds = ", ".join(f"{c} {t}" for c, t in pieces.select(*cols).dtypes)
    return numbered.mapInArrow(place, f"{kinds}, sequence_id long, offset long")
