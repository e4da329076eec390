"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

* The join works on distinct texts, named by their MD5; the members come back at
  the end by that key.
* A text's five-word shingles give one label per tree: ``DEPTH`` MinHash values of ``BITS`` bits, packed into one number, the
  first value on top.  Sorted, the labels of a tree are its prefix trie: a node of depth ``d`` is a run of labels that
  agree in their first ``d`` values.
* Representatives.  Texts that share a whole label in some tree have the smallest of these texts as their
  candidate; those at distance 0.1 or less (half of what a link allows) from it join its cluster.  Any two texts of a cluster are linked by
  the triangle inequality, so a cluster of any size costs one verification per member.
* Descent.  The matched prefix starts at the whole label and is shortened level by level.  A level's nodes
  verify, by exact Jaccard similarity, the pairs of different clusters that no longer prefix and no earlier tree of the level has brought together; nodes
  without such pairs drop out before any text is read.  After each level the links found, each weighted by the
  inverse of its chance ``1 - (1 - s^d)^trees`` to be found by now, estimate all links; the descent stops when the found ones are
  ``target_recall`` of them, at the latest at the depth where a pair at the threshold itself reaches that chance.
* A group returns its members' numbers of links and a spanning forest of the links; pairs are never written out.  A node with more
  than ``block`` texts is dealt in blocks: each pair of blocks is a group of its own, so no task holds a whole large node.  What
  is left of quadratic work is that between different clusters under one node.

Classes are the connected components of the verified links between clusters, found by
min-label steps with pointer jumping on tables written down after each round.

Texts without words have no shingles: they are linked to nothing and are in one
class with equal texts only.  The smallest id names a class (NULL ids sort
last).  An empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqweave.llm.common import U64, chunks, id_text, join_heads, mix, shingles
from seqweave.plans.stage import stage_table
from seqweave.session import ship_package

BROADCAST_KEYS = 1_000_000  # text keys with ids; more are joined by shuffle


DEPTH, BITS = 5, 12  # values of a label and their bits


def found_by(similarity: float, depth: int, trees: int) -> float:
    """Chance that a pair meets in some tree at ``depth`` or deeper."""
    return 1 - (1 - similarity**depth) ** trees


def last_depth(trees: int, threshold: float, target_recall: float) -> int:
    """The longest prefix with which a pair at the threshold is found often enough (1 if none is)."""
    return next((d for d in range(DEPTH, 1, -1) if found_by(threshold, d, trees) >= target_recall), 1)


def estimated_recall(similar: dict[int, int], depth: int, trees: int) -> float | None:
    """Share of all links that the found ones are, from their similarities (in thousandths, rounded down)."""
    found = sum(similar.values())
    if not found:
        return None
    return found / sum(n / found_by(s / 1000, depth, trees) for s, n in similar.items())


def labels_of(sh: np.ndarray, trees: int) -> np.ndarray:
    """Per tree the packed label."""
    mult = _multipliers(trees, DEPTH).reshape(-1, 1)
    low = np.full(len(mult), np.iinfo(np.uint64).max, U64)
    for s in range(0, len(sh), 512):
        low = np.minimum(low, (mult * sh[s:s + 512]).min(axis=1))
    low = (mix(low) >> U64(64 - BITS)).reshape(trees, DEPTH)
    out = np.zeros(trees, U64)
    for d in range(DEPTH):
        out = out << U64(BITS) | low[:, d]
    return out.view(np.int64)


@lru_cache(8)
def _multipliers(trees: int, max_depth: int) -> np.ndarray:
    odd = np.random.default_rng(7).integers(1, 2**63, trees * max_depth, dtype=U64) | U64(1)
    return odd.reshape(trees, max_depth)


def text_key(text):
    return F.md5(text.cast("binary"))


def _sketch(rows: DataFrame, trees: int, size: int) -> DataFrame:
    """``_key, labels`` per text with words; a task skips the copies it has met (``rows``: _key, _text)."""
    def run(batches):
        met: set[str] = set()
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            at, labels = [], []
            for k, text in zip(keys, texts, strict=True):
                if k in met:
                    continue
                met.add(k)
                sh = shingles(text, size)
                if len(sh):
                    at.append(k)
                    labels.append(labels_of(sh, trees))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.string()), pa.array(labels, pa.list_(pa.int64()))],
                                             names=["_key", "labels"])
    return rows.mapInArrow(run, "_key string, labels array<long>")


def _shingle_sets(rows: DataFrame, size: int) -> DataFrame:
    """``_key, shingles`` (binary: the sorted 64-bit hashes) of ``rows`` (_key, _text)."""
    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in chunks(texts):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i),
                     pa.array([shingles(t, size).tobytes() for t in texts[i:j]], pa.binary())],
                    names=["_key", "shingles"])
    return rows.mapInArrow(run, "_key string, shingles binary")


class _Overlaps:
    """Sizes of the intersections of a set with each of ``sets`` (the shared index is built when first needed)."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.index = None

    def sizes(self, x: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Per set the size of its intersection with ``x``; sets that are not ``wanted`` may be left at 0."""
        few = np.flatnonzero(wanted)
        out = np.zeros(len(self.sets), np.int64)
        if 4 * len(few) <= len(self.sets):
            for c in few.tolist():
                small, large = sorted((x, self.sets[c]), key=len)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                out[c] = np.count_nonzero(large[at] == small)
            return out
        if self.index is None:
            every = np.concatenate(self.sets)
            order = np.argsort(every, kind="stable")
            owner = np.repeat(np.arange(len(self.sets)), [len(y) for y in self.sets])
            self.index = every[order], owner[order]
        every, owner = self.index
        lo, hi = np.searchsorted(every, x, "left"), np.searchsorted(every, x, "right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return np.bincount(owner[at], minlength=len(self.sets))


def _jaccard_at_least(a, b, inter, threshold: float):
    return inter >= threshold * (a + b - inter) - 1e-9


def _attach(threshold: float):
    """Group function over a candidate representative (``first``) and texts that share a label with it: the texts that
    join its cluster."""
    def run(table: pa.Table) -> pa.Table:
        first = table.column("first").to_pylist()
        keys = table.column("_key").to_pylist()
        sets = table.column("shingles")
        lead = np.frombuffer(sets[first.index(True)].as_py(), U64)
        joined = []
        for i, k in enumerate(keys):
            x = np.frombuffer(sets[i].as_py(), U64)
            small, large = sorted((x, lead), key=len)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            if not first[i] and _jaccard_at_least(len(x), len(lead), np.count_nonzero(large[at] == small), threshold):
                joined.append(k)
        return pa.table({"_key": pa.array(joined, pa.string()),
                         "cluster": pa.array([keys[first.index(True)]] * len(joined), pa.string())})
    return run


def clusters_of(sk: DataFrame, payload: DataFrame, threshold: float, block: int) -> DataFrame:
    """``_key, cluster`` (the representative's key) of the texts that join one; representatives are not listed.

    ``sk``: ``_key, labels`` of the distinct texts, ``payload``: ``_key, shingles`` of those that share a label, both staged.
    """
    member = sk.select("_key", F.posexplode("labels").alias("tree", "label")).select(
        "_key", F.xxhash64("tree", "label").alias("node"))
    heads, seen = stage_table(member.groupBy("node").agg(F.count(F.lit(1)).alias("_n"), F.min("_key").alias("lead")).filter("_n > 1"),
                              "label-heads", {"n": F.sum("_n")})
    near = join_heads(member, heads, "node", int(seen["n"] or 0)).groupBy("_key").agg(F.min("lead").alias("lead"))
    near, seen = stage_table(near, "leads", {"n": F.count(F.lit(1))})
    # a representative is the smallest text of all its nodes
    roots = near.filter(F.col("lead") == F.col("_key")).select("lead")
    wanting = near.filter(F.col("lead") != F.col("_key"))
    leads = stage_table(wanting.groupBy("lead").agg(F.count(F.lit(1)).alias("_n")).join(roots, "lead").withColumn(
        "parts", F.ceil(F.col("_n") / block).cast("int")), "representatives")
    texts = join_heads(wanting, leads, "lead", int(seen["n"] or 0)).select(
        "_key", "lead", F.pmod(F.xxhash64("_key"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("first"))
    own = leads.select(F.col("lead").alias("_key"), "lead", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                       F.lit(True).alias("first"))
    rows = stage_table(texts.unionByName(own), "attachments")
    full = rows.join(payload, "_key")
    return full.groupBy("lead", "part").applyInArrow(_attach(threshold), "_key string, cluster string")


_FOUND = pa.schema([("_key", pa.string()), ("links", pa.int64()), ("other", pa.string()), ("similar", pa.int32())])


def _verify(threshold: float, depth: int):
    """Group function over one pair of blocks of one trie node (``lone``: blocks that differ): per text its links, the
    edges of a spanning forest, and how many links have which similarity."""
    shift, deeper = np.int64(BITS * (DEPTH - depth)), np.int64(BITS * (DEPTH - depth - 1))

    def run(table: pa.Table) -> pa.Table:
        tree, lone = table.column("tree")[0].as_py(), table.column("lone")[0].as_py()
        once = {k: i for i, k in enumerate(table.column("_key").to_pylist())}  # repeated rows count once
        table = table.take(pa.array(sorted(once.values()), pa.int64()))
        key = table.column("_key").to_pylist()
        labels = np.array(table.column("labels").to_pylist(), np.int64)
        sets = [np.frombuffer(x, U64) for x in table.column("shingles").to_pylist()]
        of = np.unique(np.array(table.column("cluster").to_pylist()), return_inverse=True)[1]
        side = table.column("side").to_numpy()
        rows = np.flatnonzero(side == 0)
        cols = np.flatnonzero(side == 1) if lone else rows
        size = np.array([len(x) for x in sets])
        links = np.zeros(len(key), np.int64)
        similar: dict[int, int] = {}
        root = list(range(len(key)))
        edges: list[tuple[int, int]] = []

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        overlaps = _Overlaps([sets[c] for c in cols])
        for s in range(0, len(rows) if len(cols) else 0, 64):
            part = rows[s:s + 64]
            a, b = size[part][:, None], size[cols][None, :]
            ok = np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9  # no pair beyond this ratio can reach it
            ok &= of[part][:, None] != of[cols][None, :]
            for t in range(labels.shape[1]):
                x, y = labels[part, t][:, None], labels[cols, t][None, :]
                if t < tree:  # an earlier tree in which the prefixes agree has verified the pair
                    ok &= x >> shift != y >> shift
                elif depth < DEPTH:  # a longer prefix has
                    ok &= x >> deeper != y >> deeper
            if not lone:
                ok &= part[:, None] < cols[None, :]
            for i in np.flatnonzero(ok.any(axis=1)).tolist():
                inter = overlaps.sizes(sets[part[i]], ok[i])
                ok[i] &= _jaccard_at_least(a[i], b[0], inter, threshold)
                for c in np.flatnonzero(ok[i]).tolist():
                    level = int(1000 * inter[c] // (a[i, 0] + b[0, c] - inter[c]))
                    similar[level] = similar.get(level, 0) + 1
            for r, c in zip(*np.nonzero(ok), strict=True):
                x, y = int(part[r]), int(cols[c])
                links[x] += 1
                links[y] += 1
                fx, fy = find(x), find(y)
                if fx != fy:
                    root[fx] = fy
                    edges.append((x, y))
        hit = np.flatnonzero(links).tolist()
        return pa.table([
            pa.array([key[i] for i in hit] + [key[a] for a, _ in edges] + [None] * len(similar), pa.string()),
            pa.array([int(links[i]) for i in hit] + [0] * len(edges) + list(similar.values()), pa.int64()),
            pa.array([None] * len(hit) + [key[b] for _, b in edges] + [None] * len(similar), pa.string()),
            pa.array([None] * (len(hit) + len(edges)) + list(similar), pa.int32()),
        ], schema=_FOUND)

    return run


def _level(texts: DataFrame, payload: DataFrame, threshold: float, depth: int, block: int) -> DataFrame:
    """What the nodes of one depth find (``texts``: ``_key, labels, cluster``, staged)."""
    each = texts.select("_key", "cluster", F.posexplode("labels").alias("tree", "label"))
    prefix = F.shiftright("label", BITS * (DEPTH - depth))
    child = F.shiftright("label", BITS * (DEPTH - depth - 1)) if depth < DEPTH else F.col("_key")
    member = each.select("_key", "cluster", "tree", F.xxhash64("tree", prefix).alias("node"), child.alias("_child"))
    nodes = member.groupBy("node").agg(
        F.count(F.lit(1)).alias("_n"), F.min("cluster").alias("_c0"), F.max("cluster").alias("_c1"),
        F.min("_child").alias("_k0"), F.max("_child").alias("_k1"))
    nodes = nodes.filter("_n > 1 AND _c0 <> _c1 AND _k0 <> _k1").select("node", "_n", F.ceil(F.col("_n") / block).cast("int").alias("nb"))
    nodes, seen = stage_table(nodes, "nodes", {"n": F.sum("_n")})
    # block numbers by hash: a text of a large node goes with every block of the node once
    placed = join_heads(member.select("_key", "tree", "node"), nodes, "node", int(seen["n"] or 0)).withColumn(
        "mine", F.pmod(F.xxhash64("_key"), F.col("nb")).cast("int"))
    dealt = placed.select("_key", "tree", "node", "mine", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o"))
    dealt = dealt.select("_key", "tree", "node", F.least("mine", "o").alias("x"), F.greatest("mine", "o").alias("y"),
                         F.when(F.col("mine") <= F.col("o"), 0).otherwise(1).alias("side"))
    full = dealt.withColumn("lone", F.col("x") != F.col("y")).join(payload.join(texts, "_key"), "_key")
    found = full.groupBy("node", "x", "y").applyInArrow(
        _verify(threshold, depth), "_key string, links long, other string, similar int")
    return stage_table(found, f"links-{depth}")


def text_links(rows: DataFrame, threshold: float = 0.8, size: int = 5, trees: int = 16, target_recall: float = 0.9999,
               block: int = 512) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(_key, cluster)`` of clustered texts, ``(_key, n_links)`` of links outside the own cluster, and edges ``(a, b)`` that
    connect the clusters of linked texts (a text without a cluster is its own).

    ``rows`` has ``_key, _id, _text``; rows may repeat a text.
    """
    ship_package(rows.sparkSession)
    sk = stage_table(_sketch(rows.select("_key", "_text"), trees, size).dropDuplicates(["_key"]), "sketches")
    last = last_depth(trees, threshold, target_recall)
    payload = _payload(rows, sk, last, size)
    clusters = stage_table(clusters_of(sk, payload, 1 - (1 - threshold) / 2, block), "clusters")
    # representatives are in their own cluster too
    texts = stage_table(sk.join(clusters, "_key", "left").select("_key", "labels", F.coalesce("cluster", "_key").alias("cluster")), "texts")
    found, similar = None, {}
    for depth in range(DEPTH, last - 1, -1):
        level = _level(texts, payload, threshold, depth, block)
        found = level if found is None else found.unionByName(level)
        for r in level.filter("similar IS NOT NULL").groupBy("similar").agg(F.sum("links").alias("n")).collect():
            similar[r["similar"]] = similar.get(r["similar"], 0) + r["n"]  # at most 1001 rows
        recall = estimated_recall(similar, depth, trees)
        if recall is not None and recall >= target_recall:
            break
    found = found.filter("similar IS NULL")
    links = found.groupBy("_key").agg(F.sum("links").alias("n_links")).filter("n_links > 0")
    own = texts.select("_key", "cluster")
    edges = found.filter(F.col("other").isNotNull()).select("_key", "other")
    edges = edges.join(own, "_key").select(F.col("cluster").alias("a"), F.col("other").alias("_key")).join(own, "_key").select(
        "a", F.col("cluster").alias("b"))
    return clusters, links, edges.distinct()


def _payload(rows: DataFrame, sk: DataFrame, depth: int, size: int) -> DataFrame:
    """``_key, shingles`` of the texts that meet another one at ``depth``, staged."""
    each = sk.select("_key", F.posexplode("labels").alias("tree", "label"))
    member = each.select("_key", F.xxhash64("tree", F.shiftright("label", BITS * (DEPTH - depth))).alias("node"))
    nodes, met = stage_table(member.groupBy("node").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "shared-nodes", {"n": F.sum("_n")})
    wanted, seen = stage_table(join_heads(member, nodes, "node", int(met["n"] or 0)).select(F.col("_key").alias("_want")).distinct(),
                               "wanted", {"n": F.count(F.lit(1))})
    chosen = rows.groupBy("_key").agg(F.min(F.struct(F.col("_id").isNull(), "_id")).alias("_one")).select(
        F.col("_key").alias("_ckey"), F.col("_one._id").alias("_cid"))
    small = int(seen["n"] or 0) <= BROADCAST_KEYS
    wanted = wanted.join(chosen, F.col("_want") == F.col("_ckey"))
    # one row of each text
    texts = rows.join(F.broadcast(wanted) if small else wanted,
                      (F.col("_key") == F.col("_want")) & F.col("_id").eqNullSafe(F.col("_cid")), "left_semi")
    # (rows that repeat its id too are dropped where they meet)
    return stage_table(_shingle_sets(texts.select("_key", "_text"), size).dropDuplicates(["_key"]), "shingles")


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``node, label``: the smallest node of each component (nodes with an edge only).

    Every round takes the smallest label among the neighbours and then the label of that label; it
    stops when no label changes.  Rounds grow with the logarithm of a component's diameter.
    """
    both = stage_table(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    label = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    label = stage_table(label, "labels")
    for _ in range(max_rounds):
        near = both.join(label, both["b"] == label["node"]).groupBy("a").agg(F.min("label").alias("m"))
        step = label.join(near, F.col("node") == F.col("a")).select(
            "node", F.least("label", "m").alias("new"), F.col("label").alias("old"))
        jump = step.select(F.col("node").alias("j"), F.col("new").alias("far"))
        step = step.join(jump, F.col("new") == F.col("j"), "left").select(
            "node", F.least(F.col("new"), F.coalesce("far", "new")).alias("label"), "old")
        step, seen = stage_table(step, "labels", {"moved": F.sum((F.col("label") != F.col("old")).cast("long"))})
        label = step.select("node", "label")
        if not seen["moved"]:
            return label
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                       **options) -> DataFrame:
    """Per row of ``docs``: ``_id, _key`` (MD5 of the text), ``text_id`` (smallest id with the equal text),
    ``class_id`` (smallest id reachable through links or equal texts), ``n_links`` (different texts linked)."""
    rows = id_text(docs, id_col, text_col)
    rows = rows.select(text_key(F.col("_text")).alias("_key"), "_id", "_text")
    members, all_rows = stage_table(rows.select("_key", "_id"), "members", {"n": F.count(F.lit(1))})
    n_rows = int(all_rows["n"] or 0)
    clusters, links, edges = text_links(rows, threshold, **options)
    # a cluster's label comes to its texts; every two of them are linked
    joined = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"))
    found = components(edges).select(F.col("node").alias("cluster"), F.col("label").alias("_found"))
    labels = stage_table(joined.join(found, "cluster", "full").select(
        "cluster", F.coalesce("_n", F.lit(0)).alias("_n"), F.coalesce("_found", "cluster").alias("_class")), "cluster-labels")
    of_leads = labels.select(F.col("cluster").alias("_key"), "_class", F.col("_n").alias("_inside"))
    heads = labels.filter("_n > 0").select("cluster", "_n", "_class", F.col("_n").alias("_inside"))
    of_texts = join_heads(clusters, heads, "cluster", n_rows).select("_key", "_class", "_inside")
    labelled = of_leads.unionByName(of_texts)
    firsts = members.groupBy("_key").agg(F.min("_id").alias("text_id"), F.count(F.lit(1)).alias("_rows"))
    per_text = firsts.join(links, "_key", "left").join(labelled, "_key", "left").select(
        "_key", "text_id", "_rows", (F.coalesce("n_links", F.lit(0)) + F.coalesce("_inside", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("_class", "_key").alias("_class"))
    per_text = stage_table(per_text, "per-text")
    classes = per_text.groupBy("_class").agg(F.min("text_id").alias("class_id"), F.count(F.lit(1)).alias("_n"))
    per_text = join_heads(per_text, classes, "_class", n_rows).select("_key", "text_id", "class_id", "n_links", F.col("_rows").alias("_n"))
    return join_heads(members, stage_table(per_text, "text-classes"), "_key", n_rows).select(
        "_id", "_key", "text_id", "class_id", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
             **options) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id (of rows that repeat its id
    and text, one).  All columns are kept."""
    classes = stage_table(similarity_classes(docs, id_col, text_col, threshold, **options), "classes")
    keep = classes.groupBy("_id", "_key", "class_id").agg(F.count(F.lit(1)).alias("_n"))
    lead = keep.groupBy("class_id").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_key", "_n")).alias("_lead"))
    lead, seen = stage_table(lead.select("_lead.*"), "leads", {"n": F.count(F.lit(1)), "twice": F.max("_n")})
    lead = lead.select(F.col("_id").alias("_lid"), F.col("_key").alias("_lkey"), "_n")
    wrapped = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).alias("_id"),
                          text_key(F.coalesce(F.col(text_col), F.lit(""))).alias("_key"))
    same = F.col("_id").eqNullSafe(F.col("_lid")) & (F.col("_key") == F.col("_lkey"))
    columns = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns]
    if int(seen["twice"] or 0) <= 1:
        return wrapped.join(lead, same, "left_semi").select(*columns)
    once = wrapped.join(lead.filter(F.col("_n") == 1), same, "left_semi")
    again = wrapped.join(lead.filter(F.col("_n") > 1), same, "left_semi").dropDuplicates(["_id", "_key"])
    return once.unionByName(again).select(*columns)
