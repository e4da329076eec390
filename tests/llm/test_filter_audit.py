"""Filter audit against running every order over every document."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqweave.llm import filter_audit as fa

WORD = re.compile("[^\x20\x09-\x0D]+")


def fails(docs):
    """Set of failed filters per row of (id, text, part)."""
    out = []
    for i, text, _ in docs:
        t = text or ""
        w = WORD.findall(t)
        f = {name for name, bad in zip("ABCD", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            re.search(r"[#$%&*|]", t)), strict=True) if bad}
        if any((j is not None and (i is None or j < i)) and (u or "") == t for j, u, _ in docs):
            f.add("E")
        out.append(f)
    return out


def brute_force(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failed = fails(docs)
    rows, shapley = [], Counter()
    for part in {p or "" for _, _, p in docs}:
        mine = [(d[0], f) for d, f in zip(docs, failed, strict=True) if (d[2] or "") == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                kept = [(i, f) for i, f in left if name not in f]
                every = sum(name in f for _, f in mine)
                rows.append([part, order, step, len(kept), len(gone), every - len(gone), sum(f == {name} for _, f in mine),
                             sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)])
                shapley[part, name] += len(gone)
                left = kept
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in rows)


def run(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("mask", F.lit("x")).withColumn("_id", F.lit(0))
    x = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    return sorted(map(tuple, fa.filter_audit(d.repartition(3), x).collect()))


def test_brute_force_with_edge_cases(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    docs = []
    for i in range(70):
        text = " ".join(rng.sample(words, rng.choice([5, 99, 100, 130])))
        if rng.random() < 0.3:
            text = " ".join([text] * 2)
        if rng.random() < 0.3:
            text = text.upper()
        if rng.random() < 0.3:
            text += rng.choice(["#", " $5", "*"])
        docs.append((i, text, rng.choice(["en", "de", "", None])))
    copies = [(200 + i, rng.choice(docs)[1], rng.choice(["en", "fr"])) for i in range(40)]
    odd = [(300, None, "en"), (301, "", "en"), (None, "", "de"), (None, docs[0][1], None), (None, "alone", "en"), (None, "alone", "en"),
           (5, docs[5][1], docs[5][2]), (5, docs[5][1], "xx"), (302, "É" * 10 + "Z", "en"), (303, "a\x0bb\x0cc\x85d", "en")]
    docs += copies + odd
    rng.shuffle(docs)
    labels = [(rng.randrange(320), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(200)] + [(None, 1, 1), (99999, 1, 1)]
    assert run(spark, docs, labels) == brute_force(docs, labels)


def test_empty_tables(spark):
    assert run(spark, [], [(1, 1, 1)]) == []
    assert run(spark, [(1, "a", "en")], []) == brute_force([(1, "a", "en")], [])


@pytest.mark.parametrize("size", [16, 100, 1 << 20])
def test_slices_count_the_same_words(size):
    data = ("one two\tthree é\x0b four\r\n" * 50 + "x" * 300).encode()
    assert fa.word_counts(data, size) == (len(data.split()), len(set(data.split())))


def test_ranks_and_intervals():
    orders = list(itertools.permutations(range(5)))
    assert fa.orders().tolist() == [list(o) for o in orders]
    assert [fa.lehmer_rank(o) for o in orders] == list(range(120))
    for mask in range(32):
        at = np.full(120, -1)
        for step, low, high in fa.intervals(mask):
            assert (at[low:high] == -1).all()
            at[low:high] = step
        want = [next((s for s, f in enumerate(o) if mask >> f & 1), -1) for o in orders]
        assert at.tolist() == want
