"""Length rank and histogram, in one window and in ordered ranges of hot groups."""

import random

from seqweave.operators.ranking import length_histogram, rank_by_length


def test_rank_matches_sort(spark):
    rnd = random.Random(1)
    rows = [(g, k, rnd.randint(1, 20)) for g in range(3) for k in range(60)]
    df = spark.createDataFrame(rows, "g int, k long, length int")
    for per_task in (10**9, 7):  # one window, then ordered ranges
        got = {(r["g"], r["k"]): r["rank"] for r in rank_by_length(df, ["g"], "k", rows_per_task=per_task).collect()}
        for g in range(3):
            members = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
            ranks = [got[(g, r[1])] for r in members]
            assert ranks == list(range(1, len(members) + 1))


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 9), (0, 3, 5)], "g int, k long, length int")
    for per_task in (10**9, 1):
        got = {r["k"]: r["rank"] for r in rank_by_length(df, ["g"], "k", rows_per_task=per_task).collect()}
        assert got == {1: 2, 2: 1, 3: 1}


def test_histogram(spark):
    df = spark.createDataFrame([(0, 1, 5), (0, 2, 5), (1, 3, 2)], "g int, k long, length int")
    got = sorted(tuple(r) for r in length_histogram(df, ["g"]).collect())
    assert got == [(0, 5, 2), (1, 2, 1)]


def test_ranges_are_bounded(spark):
    """However small a task's share is said to be, the tasks that report to the driver are bounded."""
    df = spark.range(20_000).selectExpr("id k", "'a' g", "cast(id % 3 as int) length")
    seen = []

    def ranges(self, n, *cols):
        seen.append(n)
        return by_range(self, 8, *cols)

    frame = type(df)
    by_range = frame.repartitionByRange
    frame.repartitionByRange = ranges
    try:
        got = rank_by_length(df, ["g"], "k", rows_per_task=1)
    finally:
        frame.repartitionByRange = by_range
    assert seen and max(seen) <= 2_000
    assert got.filter("rank = 1").collect()[0]["k"] == 2
    assert [r["rank"] for r in got.select("rank").orderBy("rank").collect()] == list(range(1, 20_001))
