"""Exact removal of repeated byte strings with suffix arrays by linear grouping.

A string of ``length`` bytes is repeated if it also starts anywhere else.  Comparing all suffixes of a
corpus needs no suffix array of the corpus; the work is cut by content:

1. Every window of ``length`` bytes has an anchor, the rightmost smallest 16-byte hash among the first
   ``spread`` places; equal windows have equal anchors at equal distances.  All windows of an anchor
   share a core of bytes; cores are counted over the corpus and windows of unique cores are settled.
2. The windows of a repeated core are cut into slices of ``step`` neighbouring windows that share all
   but ``step`` - 1 bytes on either side.  A slice becomes a record: left bytes, the shared core (one
   symbol, named by two 64-bit hashes), right bytes.  Equal records are one record with a count of
   places, which takes copies and common passages together before anything is grouped.
3. The records of a core meet in one shard.  A shard is the text of its records over an integer
   alphabet, and its suffix array is built by linear grouping: suffixes are grouped by their Lyndon
   prefixes in descending order of groups with previous-smaller pointers, then every group's order is
   emitted in one ascending pass, without recursive renaming.  Windows that are neighbours in the
   suffix array and agree in all their symbols are repeated.
4. The decisions go back to the texts, where covered bytes are removed.

A shard holds whole cores up to ``shard_symbols``.  A passage that many documents hold between other texts
gives its edges' cores a record for each of them, so cores that may have more symbols are counted first and
settled by shuffles: their records' windows, named by core, distance and the ``step`` - 1 bytes beside the
core, are counted, and no such core meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqweave.llm.common import U64, SpanHasher, chunks
from seqweave.plans.stage import stage_table
from seqweave.session import ship_package

GRAM = 16  # bytes hashed at a place
SEGMENT = 400_000  # bytes scanned at a time; a longer text is scanned in overlapping segments
_LOW = (1 << 24) - 1


# ------------------------------------------------------------------ linear grouping
def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of a list of integers (a suffix that is a prefix of another comes first).

    Phase 1: groups of suffixes with equal known prefix, the order of groups being that of the prefixes.
    From the highest group down, a group's suffixes leave the list of open places; the open place before
    a suffix is its previous smaller one, whose prefix is now known to be followed by the group's prefix,
    once for each suffix of the group that points to it.  Places move to a new group right above their
    old one, those with more repetitions higher.  At the end a suffix's group is its Lyndon prefix.

    Phase 2: behind its Lyndon prefix a suffix continues with a smaller suffix, so going through the
    suffixes in ascending order places, for each, the suffixes that continue with it at the next free
    place of their groups.
    """
    n = len(text)
    if not n:
        return []
    by_symbol: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        by_symbol.setdefault(symbol, []).append(i)
    members = [by_symbol[symbol] for symbol in sorted(by_symbol)]
    group = [0] * n
    for g, places in enumerate(members):
        for i in places:
            group[i] = g
    size = [1] * len(members)  # length of the prefix that a group shares
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    before, after = list(range(-1, n)), list(range(1, n + 2))  # open places; before[0] = -1: none
    ordered: list[tuple[int, list[int]]] = []  # finished groups, highest first
    g = len(members) - 1
    while g >= 0:
        mine = sorted([i for i in members[g] if group[i] == g])
        if mine:
            ordered.append((g, mine))
            hits: dict[int, int] = {}
            for i in mine:
                p, q = before[i], after[i]
                if p >= 0:
                    after[p] = q
                if q < n:
                    before[q] = p
            for i in mine:
                p = before[i]
                if p >= 0:
                    hits[p] = hits.get(p, 0) + 1
            counts = sorted(set(hits.values()), reverse=True)
            for k in counts:
                moved: dict[int, list[int]] = {}
                for p, times in hits.items():
                    if times == k:
                        moved.setdefault(group[p], []).append(p)
                for old, places in moved.items():
                    new, up = len(members), above[old]
                    members.append(places)
                    size.append(size[old] + k * size[g])
                    below.append(old)
                    above.append(up)
                    above[old] = new
                    below[up] = new
                    for p in places:
                        group[p] = new
        g = below[g]
    return _emit(n, ordered, group, size)


def _emit(n: int, ordered: list[tuple[int, list[int]]], group: list[int], size: list[int]) -> list[int]:
    free: dict[int, int] = {}
    at = 0
    for g, mine in reversed(ordered):
        free[g] = at
        at += len(mine)
    waiting: list[list[int] | None] = [None] * (n + 1)
    for i in range(n):
        behind = i + size[group[i]]
        if waiting[behind] is None:
            waiting[behind] = [i]
        else:
            waiting[behind].append(i)
    order = [0] * n
    for j in waiting[n] or ():
        g = group[j]
        order[free[g]] = j
        free[g] += 1
    for i in range(n):
        for j in waiting[order[i]] or ():
            g = group[j]
            order[free[g]] = j
            free[g] += 1
    return order


# ------------------------------------------------------------------ anchors, cores, records
def _window_min(key: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, from running minima inside blocks of ``w``."""
    n = len(key)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, U64)
    padded[:n] = key
    blocks = padded.reshape(-1, w)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n - w + 1], head[w - 1:n])


class Anchors:
    """Anchors of the windows of some texts laid end to end: ``text`` (index), ``at`` (anchor), ``lo`` and
    ``hi`` (first and last window of the anchor, places in the joined buffer) and ``core`` (hash)."""

    def __init__(self, texts: list[bytes], length: int, spread: int):
        self.buf = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.hash = SpanHasher(self.buf)
        found = []
        if len(self.buf) >= length:
            i = np.arange(len(self.buf) - GRAM + 1)
            key = (self.hash.spans(i, i + GRAM) & ~U64(_LOW)) | (U64(_LOW) - i.astype(U64))
            best = (U64(_LOW) - (_window_min(key, spread) & U64(_LOW))).astype(np.int64)
            for k in np.flatnonzero(self.sizes >= length):
                s = self.starts[k]
                mine = best[s:s + self.sizes[k] - length + 1]
                last = np.append(np.flatnonzero(np.diff(mine)), len(mine) - 1)
                first = np.concatenate(([0], last[:-1] + 1))
                found.append(np.stack((np.full(len(last), k), mine[last], s + first, s + last)))
        all_found = np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)
        self.text, self.at, self.lo, self.hi = all_found
        self.core = self.hash.spans(self.at, self.at + length - spread + 1)


def _segments(texts: list[bytes], length: int) -> list[tuple[int, int, bytes]]:
    """(text index, offset, bytes): long texts in pieces that overlap by ``length`` - 1 bytes."""
    out = []
    for k, t in enumerate(texts):
        for s in range(0, max(1, len(t) - length + 1), SEGMENT):
            out.append((k, s, t[s:s + SEGMENT + length - 1]))
    return out


def _joined(keys: list, texts: Iterable[str], length: int, met: set):
    """Groups of (key, offset, bytes) of about ``SEGMENT`` bytes, texts met before in this task left out."""
    batch, size = [], 0
    for key, text in zip(keys, texts, strict=True):
        if key in met:
            continue
        met.add(key)
        for _, s, piece in _segments([text.encode()], length):
            batch.append((key, s, piece))
            size += len(piece)
            if size > SEGMENT:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def core_table(rows: DataFrame, length: int, spread: int) -> DataFrame:
    """``core, key, at``: one row per anchor of every text (``rows``: ``_key, _text``)."""
    def run(batches):
        met: set[int] = set()
        for b in batches:
            for part in _joined(b.column(0).to_pylist(), (x.as_py() for x in b.column(1)), length, met):
                a = Anchors([p for _, _, p in part], length, spread)
                key = np.array([k for k, _, _ in part], np.int64)[a.text] if len(a.at) else np.empty(0, np.int64)
                off = np.array([s for _, s, _ in part], np.int64)
                at = a.at - a.starts[a.text] + off[a.text]
                yield pa.RecordBatch.from_arrays([pa.array(a.core.view(np.int64)), pa.array(key), pa.array(at)],
                                                 names=["core", "key", "at"])
    return rows.mapInArrow(run, "core long, key long, at long")


_RECORD = "h1 long, h2 long, left binary, right binary, key long, at long"


def record_table(rows: DataFrame, length: int, spread: int, step: int, wanted: np.ndarray | None) -> DataFrame:
    """Records of the windows whose core is repeated: ``h1, h2`` (the shared core), ``left, right`` (bytes
    beside it), ``key, at`` (text and place of the first window).

    ``rows`` has ``_key, _text`` and, if the repeated cores are not given as ``wanted``, ``_cores``.
    """
    shared = None if wanted is None else rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        met: set[int] = set()
        for b in batches:
            keys = b.column(0).to_pylist()
            cores = dict(zip(keys, b.column(2).to_pylist(), strict=True)) if shared is None else {}
            for part in _joined(keys, (x.as_py() for x in b.column(1)), length, met):
                a = Anchors([p for _, _, p in part], length, spread)
                if shared is None:
                    want = np.sort(np.array([c for k in {k for k, _, _ in part} for c in cores[k] or ()], np.int64))
                else:
                    want = shared.value
                if not len(a.at) or not len(want):
                    continue
                mine = a.core.view(np.int64)
                use = want[np.minimum(np.searchsorted(want, mine), len(want) - 1)] == mine
                at, lo, hi, text = a.at[use], a.lo[use], a.hi[use], a.text[use]
                s0, s1 = (at - hi) // step, (at - lo) // step
                n = s1 - s0 + 1
                rep = np.repeat(np.arange(len(at)), n)
                s = s0[rep] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                c0 = at[rep] - s * step  # the shared core starts here and ends at c1
                c1 = c0 - step + 1 + length
                w0, w1 = np.maximum(lo[rep], c0 - step + 1), np.minimum(hi[rep], c0)
                other = SpanHasher(a.buf, 2)
                raw = a.buf.tobytes()
                key = np.array([k for k, _, _ in part], np.int64)[text[rep]]
                off = np.array([o for _, o, _ in part], np.int64)[text[rep]]
                for i in range(0, len(rep), 50_000):
                    j = slice(i, i + 50_000)
                    left = [raw[x:y] for x, y in zip(w0[j].tolist(), c0[j].tolist(), strict=True)]
                    right = [raw[x:y] for x, y in zip(c1[j].tolist(), (w1[j] + length).tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(a.hash.spans(c0[j], c1[j]).view(np.int64)), pa.array(other.spans(c0[j], c1[j]).view(np.int64)),
                        pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array(key[j]),
                        pa.array(w0[j] - a.starts[text[rep[j]]] + off[j])],
                        names=["h1", "h2", "left", "right", "key", "at"])
    return rows.mapInArrow(run, _RECORD)


def repeated_windows(records: list[tuple[tuple, bytes, bytes]], step: int) -> list[list[int]]:
    """For each record (core, left, right) of one shard the numbers of its windows that occur in another
    record of the shard; decided on the suffix array of the shard's text."""
    name: dict[tuple, int] = {}
    text: list[int] = []
    start, owner = [], []
    for r, (core, left, right) in enumerate(records):
        begin = len(text)
        text += [x + 1 for x in left]
        text.append(name.setdefault(core, 257 + len(name)))
        text += [x + 1 for x in right]
        text.append(0)
        windows = len(left) + len(right) + 2 - step  # step symbols each
        start += range(begin, begin + windows)
        owner += [r] * windows
    order = np.array(suffix_array(text), np.int64)
    is_start = np.full(len(text), -1, np.int64)
    is_start[start] = np.arange(len(start))
    line = is_start[order]
    line = line[line >= 0]  # window starts in suffix order
    data = np.array(text + [0] * step, np.int32)
    at = np.array(start, np.int64)[line]
    same = np.ones(max(len(at) - 1, 0), bool)
    for o in range(step):
        same &= data[at[1:] + o] == data[at[:-1] + o]
    hit = np.zeros(len(at), bool)
    hit[1:] |= same
    hit[:-1] |= same
    out: list[list[int]] = [[] for _ in records]
    first = np.searchsorted(np.array(owner), np.arange(len(records)))
    for w in np.sort(line[hit]).tolist():
        out[owner[w]].append(w - int(first[owner[w]]))
    return out


def _decide(step: int, shard_symbols: int):
    """Partition function over distinct records sorted by core: the repeated windows of each as a bit mask."""
    def solve(shard, masks):
        found = repeated_windows([(core, left, right) for core, left, right, _ in shard], step)
        for (core, left, right, many), hits in zip(shard, found, strict=True):
            windows = len(left) + len(right) + 2 - step
            mask = (1 << windows) - 1 if many else sum(1 << w for w in hits)
            if mask:
                masks.append((*core, left, right, mask))

    def out(masks):
        cols = list(zip(*masks, strict=True)) if masks else [[]] * 5
        return pa.RecordBatch.from_arrays([
            pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
            pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.int64())], names=["h1", "h2", "left", "right", "mask"])

    def settle(core_rows, shard, masks) -> int:
        """A core with one record has nothing to be compared with: its count of places decides."""
        if len(core_rows) > 1:
            shard += core_rows
            return sum(len(left) + len(right) + 2 for _, left, right, _ in core_rows)
        for core, left, right, many in core_rows:
            if many:
                masks.append((*core, left, right, (1 << (len(left) + len(right) + 2 - step)) - 1))
        return 0

    def run(batches):
        shard, core_rows, last, symbols = [], [], None, 0
        for b in batches:
            masks: list = []
            for h1, h2, left, right, many in zip(*[c.to_pylist() for c in b.columns], strict=True):
                core = (h1, h2)
                if core != last:
                    symbols += settle(core_rows, shard, masks)
                    core_rows, last = [], core
                    if symbols > shard_symbols:
                        solve(shard, masks)
                        shard, symbols = [], 0
                core_rows.append((core, left, right, many))
            yield out(masks)
        masks = []
        settle(core_rows, shard, masks)
        solve(shard, masks)
        yield out(masks)
    return run


def heavy_cores(records: DataFrame, step: int, shard_symbols: int) -> DataFrame:
    """``h1`` of the cores whose places may make more than ``shard_symbols`` symbols (2 * ``step`` a place)."""
    places = records.groupBy("h1").agg(F.count(F.lit(1)).alias("n"))
    return places.filter(F.col("n") * (2 * step) > shard_symbols).select("h1")


def counted_masks(distinct: DataFrame, step: int) -> DataFrame:
    """The masks of ``_decide`` from counts of windows: no core's records meet in one task."""
    size = F.octet_length("left") + F.octet_length("right") + (2 - step)  # windows of a record
    record = ["h1", "h2", "left", "right"]
    each = distinct.select("*", F.explode(F.sequence(F.lit(0), size - 1)).alias("w"))
    beside = F.octet_length("left") - F.col("w")  # bytes of the window before the core
    wins = each.select(*record, "many", "w", beside.alias("beside"), F.concat(
        F.expr("substring(left, w + 1)"), F.col("right").substr(F.lit(1), F.lit(step - 1) - beside)).alias("bytes"))
    window = ["h1", "h2", "beside", "bytes"]
    repeated = wins.groupBy(*window).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select(*window)
    found = wins.filter(~F.col("many")).join(repeated, window, "left_semi")
    some = found.groupBy(*record).agg(F.bit_or(F.expr("shiftleft(1L, w)")).alias("mask"))
    every = distinct.filter("many").select(*record, F.call_function(
        "shiftrightunsigned", F.lit(-1).cast("long"), F.lit(64) - size).alias("mask"))
    return some.unionByName(every)


def duplicate_windows(rows: DataFrame, length: int = 400, spread: int = 256, step: int = 16,
                      shard_symbols: int = 60_000, broadcast_cores: int = 2_000_000) -> DataFrame:
    """``key, at, mask``: bit ``i`` of ``mask`` says that the window at ``at`` + i of the text ``key`` occurs
    elsewhere.  ``rows`` has ``_key, _text`` and may repeat a text (copies count as one text here)."""
    if not GRAM < length - spread or not 1 < step <= 63:
        raise ValueError("length must exceed spread by more than a gram, step must fit a mask")
    ship_package(rows.sparkSession)
    cores = stage_table(core_table(rows, length, spread), "suffix-cores")
    place = F.xxhash64("key", "at")
    repeated = cores.groupBy("core").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter(
        F.col("a") != F.col("b")).select("core")
    repeated, seen = stage_table(repeated, "suffix-repeated", {"n": F.count(F.lit(1))})
    if int(seen["n"] or 0) <= broadcast_cores:
        # 8 bytes each, bounded by the parameter
        wanted = np.sort(np.array(repeated.toArrow().column(0), np.int64))
        records = record_table(rows, length, spread, step, wanted)
    else:
        per_text = cores.join(repeated, "core").groupBy("key").agg(F.collect_set("core").alias("_cores"))
        found = rows.join(per_text, rows["_key"] == per_text["key"]).select("_key", "_text", "_cores")
        records = record_table(found, length, spread, step, None)
    records = stage_table(records, "suffix-records")
    record = ["h1", "h2", "left", "right"]
    heavy, seen = stage_table(heavy_cores(records, step, shard_symbols), "suffix-heavy", {"n": F.count(F.lit(1))})
    n_heavy = int(seen["n"] or 0)
    marked = records.withColumn("_heavy", F.lit(None).cast("boolean"))
    if n_heavy:
        heavy = heavy.withColumn("_heavy", F.lit(True))
        marked = records.join(F.broadcast(heavy) if n_heavy <= broadcast_cores else heavy, "h1", "left")
    distinct = marked.groupBy(*record).agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("_heavy").alias("_heavy")).select(
        *record, (F.col("a") != F.col("b")).alias("many"), F.coalesce("_heavy", F.lit(False)).alias("_heavy"))
    shards = distinct.filter(~F.col("_heavy")).drop("_heavy").repartition("h1", "h2").sortWithinPartitions("h1", "h2")
    masks = shards.mapInArrow(_decide(step, shard_symbols), "h1 long, h2 long, left binary, right binary, mask long")
    if n_heavy:
        counted = stage_table(distinct.filter("_heavy").drop("_heavy"), "suffix-counted")
        masks = masks.unionByName(counted_masks(counted, step))
    masks = stage_table(masks, "suffix-masks")
    return records.join(masks, record).select("key", "at", "mask")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                   **options) -> DataFrame:
    """Per row: ``_id, n_bytes, n_removed, spans`` (maximal removed byte runs ``start, end``) and ``kept``
    (the remaining bytes).  NULL text is empty; a text shorter than ``length`` loses nothing."""
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_key"), text.alias("_text"))
    windows = duplicate_windows(src.select("_key", "_text"), length, **options)
    hits = windows.groupBy("key").agg(F.collect_set(F.struct("at", "mask")).alias("_hits"))
    copies = src.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    marks = hits.join(copies, F.col("key") == F.col("_key"), "full").select(
        F.coalesce("key", "_key").alias("_mkey"), "_hits", F.col("n").isNotNull().alias("_copied"))
    both = src.join(marks, F.col("_key") == F.col("_mkey"), "left").select("_id", "_text", "_hits", "_copied")
    step = options.get("step", 16)
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in chunks(texts):
                hits_of, copied = b.column(2).slice(i, j - i).to_pylist(), b.column(3).slice(i, j - i).to_pylist()
                size, removed, spans, kept = [], [], [], []
                for t, found, copy in zip(texts[i:j], hits_of, copied, strict=True):
                    data = t.encode()
                    n = len(data)
                    runs: list[tuple[int, int]] = []
                    if copy and n >= length:
                        runs = [(0, n)]
                    elif found:
                        at = np.array([h["at"] for h in found], np.int64)
                        mask = np.array([h["mask"] for h in found], np.int64)
                        starts = np.unique(np.concatenate([at[(mask >> o) & 1 == 1] + o for o in range(step)]))
                        new = np.append(True, starts[1:] > starts[:-1] + length)
                        last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
                        runs = list(zip(starts[new].tolist(), (starts[last] + length).tolist(), strict=True))
                    rest, at = [], 0
                    for s, e in runs:
                        rest.append(data[at:s])
                        at = e
                    size.append(n)
                    removed.append(sum(e - s for s, e in runs))
                    spans.append([{"start": s, "end": e} for s, e in runs])
                    kept.append(b"".join([*rest, data[at:]]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(spans, spans_type), pa.array(kept, pa.binary())],
                    names=["_id", "n_bytes", "n_removed", "spans", "kept"])

    kind = dict(src.dtypes)["_id"]
    return both.mapInArrow(run, f"_id {kind}, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")

