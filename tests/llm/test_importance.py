"""Importance resampling against brute force, its quickselect against sorting."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqweave.llm import importance

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def features(text, n=2):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute_force(docs, target, min_words=20, buckets=10_000):
    def bucket(f):
        return crc32(f.encode()) % buckets

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    ss, tt = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(words), len(found), weight, score, None])
    fit = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for k, r in enumerate(fit[:25 * len(fit) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=repr)


def run(spark, docs, target, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_id", F.lit(1)).withColumn("rank", F.lit(2))
    t = spark.createDataFrame([(x,) for x in target], "text string")
    rows = importance.resample(d.repartition(3), t, **options).collect()
    return sorted(((r["_id"], r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in rows), key=repr)


def test_brute_force_with_edge_cases(spark):
    rng = random.Random(3)
    vocabulary = ["Alpha", "beta", "GAMMA", "ünïcode", "x9", "a-b", "the", "of", "Ĕnd"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 19, 20, 25, 60])))) for i in range(120)]
    docs += [(None, None), (None, " ".join(["beta"] * 30)), (500, None), (501, ""), (502, "?! ..."), (3, docs[3][1]),
             (7, " ".join(["the"] * 40)), (7, " ".join(["the"] * 41)), (600, "long words " * 40_000)]
    target = ["alpha beta the of", None, "GAMMA gamma x9", ""]
    assert run(spark, docs, target) == brute_force(docs, target)


def test_registered_parameters_on_documents(spark):
    from seqweave.llm.queries import op11_importance

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = sorted(map(tuple, op11_importance(spark, sf).collect()), key=repr)
    assert got == [(r[0], *r[2:]) for r in brute_force(docs, target)]


def test_nothing_to_draw(spark):
    assert run(spark, [], ["a"]) == []
    assert run(spark, [(1, "few words")], []) == brute_force([(1, "few words")], [])


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_slices_give_the_same_features(size):
    text = "One two. THREE é four-five " * 30 + "x" * 200 + " end"
    n = sum(w for w, _ in importance.feature_buckets(text, 3, 1000, size))
    got = Counter(b for _, found in importance.feature_buckets(text, 3, 1000, size) for b in found.tolist())
    words, found = features(text, 3)
    assert n == len(words) and got == Counter(crc32(f.encode()) % 1000 for f in found)


@pytest.mark.parametrize("pivots", [1, 3, 24])
def test_quickselect_finds_every_rank(spark, pivots):
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 6)), bool(i % 5 == 0), None if i % 5 == 0 else int(rng.integers(0, 9)), 1, i) for i in range(150)]
    keys = spark.createDataFrame(rows, "_down long, _none boolean, _id long, n_features long, _row long").repartition(4).cache()
    want = sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0, r[3], r[4]))
    for k in (1, 2, 75, 149, 150):
        assert importance.kth_key(keys, k, pivots) == want[k - 1]
