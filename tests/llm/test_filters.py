"""Toxicity, line spread, Jaccard join and decontamination against brute force on small tables."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqweave.llm import decontam, line_spread, lsh_forest, toxicity

DOC = "doc_id long, text string, source string, _id string, _text string, score string, n_words string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "c", "c", "c", "c") for i, t, s in rows], DOC)


# ------------------------------------------------------------------ toxicity
def _toxic_rows(n=400):
    rng = random.Random(4)
    plain = [a + b for a in ("mo", "ta", "re", "li", "su", "ka") for b in ("na", "do", "ri", "pe", "lu", "")]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 120))]
        toxic = i % 4 == 0
        if toxic:
            words.insert(rng.randint(0, len(words)), rng.choice(["vilex", "vilexor", "grubdung", "grubdusk"]))
        text = " ".join(w + ("." if rng.random() < 0.15 else "") for w in words)
        rows.append((i, text, "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_noisy_or_learns_and_locates(spark):
    rows, labels = _toxic_rows()
    docs = frame(spark, rows)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.collect_model(toxicity.train_toxicity(docs, lab.filter("doc_id % 3 <> 1")))
    got = {r._id: r for r in toxicity.score_toxicity(docs, model).collect()}
    held = [i for i, _ in labels if i % 3 == 1]
    right = sum((got[i].score >= 0.7) == bool(labels[i][1]) for i in held)
    assert right >= 0.97 * len(held)
    for i in held:
        for s in got[i].offending:
            assert re.search("vilex|grubdu", rows[i][1][s.start:s.end])


def test_toxicity_edges(spark):
    docs = frame(spark, [(1, None, "s"), (1, "", "s"), (None, "...", "s"), (2, "İ" * 5 + " stupid. x" * 2000, "s")])
    got = toxicity.score_toxicity(docs, {toxicity.BIAS: -4.0, "stupid": 3.0}).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    empty = [r.score for r in got if r.n_sentences == 0]
    assert len(set(empty)) == 1 and empty[0] == pytest.approx(1 / (1 + np.exp(4.0)))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.collect_model(toxicity.train_toxicity(docs, none))
    assert list(model) == [toxicity.BIAS]
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_noisy_or_gradient_matches_definition():
    scorer = toxicity.SentenceScorer({toxicity.BIAS: -1.0, "bad": 2.0})
    score, parts = scorer.score("a bad one. fine! bad")
    p = [1 / (1 + np.exp(-z)) for z in (1.0, -1.0, 1.0)]
    assert [x for _, _, x in parts] == pytest.approx(p)
    assert score == pytest.approx(1 - np.prod([1 - x for x in p]))


def test_training_follows_the_numeric_gradient():
    """Three Adam steps with gradients by finite differences of the definition give the trained weights."""
    rows, labels = _toxic_rows(160)
    texts, y = [t for _, t, _ in rows], [v for _, v in labels]
    model = toxicity.fit_noisy_or(texts, y, steps=3)
    names = [k for k in model if k != toxicity.BIAS]
    assert names
    bags = {t: v for t, v in sorted(zip(texts, y))}
    docs = []
    for t in bags:
        sents = []
        for sentence in toxicity._SENTENCE.findall(t.lower()):
            feats = {f for w in set(toxicity._WORD.findall(sentence)) for f in toxicity.word_features(w)}
            sents.append(np.array([n in feats for n in names], float))
        docs.append(np.array(sents))
    truth = np.array(list(bags.values()))

    def loss(theta):
        out = 0.5e-4 * float((theta[:-1] ** 2).sum())
        for x, v in zip(docs, truth):
            p = 1 - np.prod(1 - 1 / (1 + np.exp(-(x @ theta[:-1] + theta[-1]))))
            out -= np.log(p if v else 1 - p)
        return out / len(docs)

    theta = np.append(np.zeros(len(names)), -5.0)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in (1, 2, 3):
        grad = np.array([(loss(theta + e) - loss(theta - e)) / 2e-5 for e in np.eye(len(theta)) * 1e-5])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    assert [model[n] for n in names] == pytest.approx(theta[:-1].tolist(), abs=2e-3)
    assert model[toxicity.BIAS] == pytest.approx(theta[-1], abs=2e-3)


# ------------------------------------------------------------------ line spread
def test_boilerplate_lines(spark):
    rng = random.Random(8)
    rows = [(i, "\n".join(rng.sample([" all rights ", "menu", "", "own %d" % i, "text %d" % i, "rare"], 5)),
             None if i % 9 == 0 else "site%d" % (i % 7)) for i in range(80)]
    rows += [(200, None, "site1"), (201, "", "site2"), (202, "\n\n", "site3"), (3, rows[3][1], "site3"),
             (204, "menu\nmenu\nlong own line that is most of the text", "site1"), (None, "menu\nlong own line again", "x")]
    for sites, texts, limit in ((5, 1, 200_000), (9, 20, 200_000), (8, 30, 0), (1, 2, 0), (7, 60, 0)):
        spread, held = defaultdict(set), defaultdict(set)
        for _, t, s in rows:
            for line in (t or "").split("\n"):
                spread[line.strip(" ")].add(s)
                held[line.strip(" ")].add(t)
        bad = {k for k, v in spread.items() if k and len(v) >= sites and len(held[k]) >= texts}
        want = [(str(i), "\n".join(x for x in (t or "").split("\n") if x.strip(" ") not in bad)) for i, t, _ in rows]
        got = line_spread.remove_boilerplate(frame(spark, rows), min_sites=sites, min_texts=texts, broadcast_lines=limit)
        assert got.columns == frame(spark, rows).columns
        assert sorted((str(r.doc_id), r.text or "") for r in got.collect()) == sorted(want)
    assert line_spread.remove_boilerplate(frame(spark, rows).limit(0)).count() == 0


def test_a_line_on_a_third_of_all_rows(spark):
    """Heavy keys are broadcast, their rows stay in place: the same result without Spark's own broadcasts."""
    rows = [(i, f"own {i}\nmenu\n" + ("menu\n" * 3 if i % 2 else "") + f"pair {i // 2}", f"site{i % 40}") for i in range(1500)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.doc_id: r.text for r in line_spread.remove_boilerplate(frame(spark, rows), broadcast_lines=0).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {i: f"own {i}\npair {i // 2}" for i, _, _ in rows}


def test_pipeline_removes_boilerplate_of_any_share(spark):
    rows = [(i, f"all rights reserved\nown {i}", f"site{i}") for i in range(12)]
    rows += [(50 + i, "one text\non many sites", f"site{i}") for i in range(12)]
    rows += [(90, "all rights reserved", "site1")]
    docs = frame(spark, rows).withColumn("n_chars", F.char_length("text"))
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_boilerplate(spark, docs, "").collect()}
    want = {i: t.replace("all rights reserved\n", "").replace("all rights reserved", "") for i, t, _ in rows}
    assert got == {i: (t, len(t)) for i, t in want.items()}


# ------------------------------------------------------------------ Jaccard join
def _near_rows():
    rng = random.Random(6)
    base = [[f"w{rng.randint(0, 999)}" for _ in range(rng.choice([4, 30, 90]))] for _ in range(20)]
    rows = []
    for i, b in enumerate(base):
        rows.append((10 * i, " ".join(b), "s"))
        for k in range(rng.randint(0, 5)):
            c = list(b)
            for _ in range(rng.randint(0, 3)):
                c[rng.randrange(len(c))] = "new%d" % rng.randint(0, 99)
            rows.append((10 * i + k + 1, " ".join(c), "s"))
    rows += [(500, rows[0][1], "s"), (501, rows[0][1].upper(), "s"), (502, None, "s"), (503, "", "s"), (504, " \t", "s"),
             (505, "one", "s"), (506, "ONE", "s"), (507, "one  two", "s"), (500, rows[0][1], "s"), (None, rows[1][1], "s")]
    return rows


def _classes(rows, threshold=0.8):
    def grams(t):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    texts = {}
    for i, t, _ in rows:
        texts.setdefault(t or "", []).append(i)
    sets = {t: grams(t) for t in texts}
    links = {t: [u for u in texts if u != t and sets[t] and len(sets[t] & sets[u]) >= threshold * len(sets[t] | sets[u])]
             for t in texts}
    label = {}
    for t in texts:
        if t in label:
            continue
        todo, seen = [t], {t}
        while todo:
            for u in links[todo.pop()]:
                if u not in seen:
                    seen.add(u)
                    todo.append(u)
        low = min(i for u in seen for i in texts[u] if i is not None)
        for u in seen:
            label[u] = low
    return {t: (min(i for i in ids if i is not None), label[t], len(links[t])) for t, ids in texts.items()}


@pytest.mark.parametrize("block", [512, 2])
def test_jaccard_classes(spark, block):
    rows = _near_rows()
    want = _classes(rows)
    got = lsh_forest.similarity_classes(frame(spark, rows), block=block).collect()
    assert sorted((str(r._id), r.text_id, r.class_id, r.n_links) for r in got) == sorted(
        (str(i), *want[t or ""]) for i, t, _ in rows)


def _sets(n=60, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    sets = []
    for k in range(n):
        x = base[:rng.integers(30, 41)].copy()
        x[:rng.integers(0, 5)] += np.uint64(k + 1)
        sets.append(np.unique(x))
    return sets


def _jaccard(a, b):
    return len(np.intersect1d(a, b)) / len(np.union1d(a, b))


@pytest.mark.parametrize("lone", [False, True])
@pytest.mark.parametrize("tree, depth", [(0, 5), (3, 5), (3, 3), (15, 2)])
def test_verify_counts_each_pair_once(lone, tree, depth):
    sets = _sets()
    labels = np.array([lsh_forest.labels_of(x, 16) for x in sets])
    side = [i % 2 if lone else 0 for i in range(60)]
    cluster = [i // 3 if i < 12 else i for i in range(60)]
    got = lsh_forest._verify(0.8, depth)(pa.table({
        "tree": pa.array([tree] * 60), "lone": pa.array([lone] * 60), "side": pa.array(side),
        "_key": pa.array([str(i) for i in range(60)]), "labels": pa.array(labels.tolist(), pa.list_(pa.int64())),
        "cluster": pa.array([str(c) for c in cluster]),
        "shingles": pa.array([x.tobytes() for x in sets], pa.binary())})).to_pylist()

    def new(i, j):
        p, q = labels[i] >> 12 * (5 - depth), labels[j] >> 12 * (5 - depth)
        longer = depth < 5 and (labels[i] >> 12 * (4 - depth) == labels[j] >> 12 * (4 - depth))[tree:].any()
        return cluster[i] != cluster[j] and not (p == q)[:tree].any() and not longer

    pairs = [(i, j) for i in range(60) for j in range(i) if not (lone and side[i] == side[j])
             and new(i, j) and _jaccard(sets[i], sets[j]) >= 0.8]
    want = Counter(str(i) for p in pairs for i in p)
    assert {r["_key"]: r["links"] for r in got if r["other"] is None and r["_key"]} == want
    assert {frozenset((int(r["_key"]), int(r["other"]))) for r in got if r["other"]} <= set(map(frozenset, pairs))
    levels = Counter(int(1000 * len(np.intersect1d(sets[i], sets[j])) // len(np.union1d(sets[i], sets[j]))) for i, j in pairs)
    assert {r["similar"]: r["links"] for r in got if r["similar"]} == levels


def test_every_pair_is_verified_at_one_level():
    """Over all trees and levels down to the last, each linked pair that shares a prefix is counted exactly once."""
    sets = _sets(40, 9)
    labels = np.array([lsh_forest.labels_of(x, 16) for x in sets])
    counted = Counter()
    for depth in (5, 4, 3):
        for tree in range(16):
            nodes = defaultdict(list)
            for i, label in enumerate(labels[:, tree] >> 12 * (5 - depth)):
                nodes[label].append(i)
            for members in nodes.values():
                got = lsh_forest._verify(0.8, depth)(pa.table({
                    "tree": pa.array([tree] * len(members)), "lone": pa.array([False] * len(members)),
                    "side": pa.array([0] * len(members)), "_key": pa.array([str(i) for i in members]),
                    "labels": pa.array(labels[members].tolist(), pa.list_(pa.int64())),
                    "cluster": pa.array([str(i) for i in members]),
                    "shingles": pa.array([sets[i].tobytes() for i in members], pa.binary())})).to_pylist()
                counted.update({r["_key"]: r["links"] for r in got if r["other"] is None and r["_key"]})
    meets = [(i, j) for i in range(40) for j in range(i) if _jaccard(sets[i], sets[j]) >= 0.8
             and (labels[i] >> 24 == labels[j] >> 24).any()]
    assert meets and counted == Counter(str(i) for p in meets for i in p)


def test_recall_against_an_exact_join(spark):
    """Links found at the registered parameters, pairs close to the threshold included."""
    rng = random.Random(31)
    rows = []
    for g in range(60):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([40, 120, 300]))]
        for k in range(6):
            c = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 70))):
                c[rng.randrange(len(c))] = f"n{rng.randrange(10**6)}"
            rows.append((100 * g + k, " ".join(c), "s"))
    want = {i: n for i, _, n in _classes(rows).values()}
    got = {r._id: r.n_links for r in lsh_forest.similarity_classes(frame(spark, rows)).collect()}
    assert sum(want.values()) > 500  # both ends of a link
    assert all(got[i] <= n for i, n in want.items())
    assert sum(got[i] for i in want) >= 0.999 * sum(want.values())


def test_a_large_group_of_near_copies(spark):
    """All pairs are linked: the cluster counts them without comparing members with each other."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(4000)}" for _ in range(400)]
    rows = []
    for k in range(900):
        c = list(base)
        c[rng.randrange(len(c))] = f"n{k}"
        rows.append((k, " ".join(c), "s"))
    rows += [(5000 + k, rows[0][1], "s") for k in range(1500)]
    got = lsh_forest.similarity_classes(frame(spark, rows), block=64).collect()
    assert len(got) == 2400 and {r.n_links for r in got} == {899} and {r.class_id for r in got} == {0}


def test_keep_one(spark):
    rows = _near_rows()
    docs = frame(spark, rows)
    kept = lsh_forest.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in _classes(rows).values()})
    assert lsh_forest.keep_one(docs.limit(0)).count() == 0


def test_descent_follows_recall():
    assert lsh_forest.last_depth(16, 0.8, 0.9999) == 3
    assert lsh_forest.last_depth(16, 0.8, 0.995) == 5
    assert lsh_forest.last_depth(2, 0.5, 0.9999) == 1
    # links of high similarity stop the descent early, links near the threshold do not
    assert lsh_forest.estimated_recall({950: 100, 900: 50}, 5, 16) >= 0.9999
    assert lsh_forest.estimated_recall({950: 100, 800: 50}, 5, 16) < 0.9999
    assert lsh_forest.estimated_recall({}, 5, 16) is None



def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(60)] + [("z1", "z0")], "a string, b string")
    got = {r.node: r.label for r in lsh_forest.components(edges).collect()}
    assert got == {**{f"n{i:03}": "n000" for i in range(61)}, "z0": "z0", "z1": "z0"}


# ------------------------------------------------------------------ decontamination
def _words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _bench_rows():
    rng = random.Random(12)
    vocabulary = ["One", "two", "drei", "café", "漢", "5", "x2", "É"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in
             enumerate([14, 10, 25, 3, 1, 0, 12])] + [(7, None), (2, "another text of item two with ten words in it ok")]
    items[4] = (4, "Einzelwort")
    items.append((10, items[0][1]))
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choice(vocabulary) + rng.choice(["", ",", "-", "\n"]) for _ in range(rng.randint(0, 30)))]
        if i % 3 == 0:
            w = _words(items[i % 7][1])
            cut = rng.randint(0, 3)
            parts.insert(0, "¡" * (i % 2) + "; ".join(w[cut:cut + 12]).upper() + " ")
        rows.append((i, " ".join(parts), "s"))
    return rows + [(100, None, "s"), (101, "", "s"), (102, "...", "s"), (0, rows[0][1], "s"), (None, rows[3][1], "s")], items


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_decontamination(spark, limit, no_broadcast):
    rows, items = _bench_rows()
    windows = defaultdict(set)
    for i, t in items:
        w = _words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k:k + n])].add(str(i))
    want, clean, spans = [], [], []
    for i, t, _ in rows:
        w, hit, found = _words(t), set(), set()
        for k in range(len(w)):
            for n in {len(x) for x in windows}:
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        want.append((str(i), len(w), sorted(hit), sorted(found)))
        if not hit:
            clean.append((str(i), t or ""))
        pieces = list(re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or ""))
        kept, at = [], 0
        for k, m in enumerate(pieces):
            end = pieces[k + 1].start() if k + 1 < len(pieces) else len(t)
            if k in hit:
                kept.append((t or "")[at:m.start()])
                at = end
        spans.append((str(i), "".join(kept) + (t or "")[at:]))
    docs = frame(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("_w", F.lit(1))
    got = decontam.contamination(docs, bench, broadcast_windows=limit).collect()
    assert sorted((str(r._id), r.n_words, sorted(r._hits), list(r._items)) for r in got) == sorted(want)
    kept = decontam.decontaminate(docs, bench, broadcast_windows=limit)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted(clean)
    cut = decontam.decontaminate(docs, bench, mode="spans", broadcast_windows=limit)
    assert sorted((str(r.doc_id), r.text or "") for r in cut.collect()) == sorted(spans)
    assert decontam.decontaminate(docs, bench.limit(0)).count() == len(rows)
    assert decontam.decontaminate(docs.limit(0), bench).count() == 0
