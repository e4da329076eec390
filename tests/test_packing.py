"""Exact next-fit-decreasing: plan arithmetic vs the literal loop, then the Spark operator."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from seqweave.operators.packing import PackSpec, assign_bins, materialize_bins
from nfd_oracle import next_fit_decreasing
from seqweave.plans.nfd import walk


def plan_bins(lengths, max_length, tail="keep"):
    """Bins from the histogram plan, members listed in pop order."""
    clamped = [min(x, max_length) for x in lengths]
    distinct = sorted(set(clamped), reverse=True)
    counts = [clamped.count(v) for v in distinct]
    b0, k0, per, last = walk(np.array(distinct), np.array(counts), max_length)
    order = sorted(range(len(lengths)), key=lambda i: (-clamped[i], -lengths[i], i))
    rank, bins = {}, {}
    for i in order:
        j = distinct.index(clamped[i])
        r = rank.get(j, 0)
        rank[j] = r + 1
        b = b0[j] if r < k0[j] else b0[j] + 1 + (r - k0[j]) // per[j]
        bins.setdefault(int(b), []).append(i)
    if tail == "drop" and last is not None:
        bins.pop(int(last), None)
    return [bins[k] for k in sorted(bins)]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=40), st.integers(1, 40))
def test_plan_equals_sequential_loop(lengths, max_length):
    for oversize in ("truncate", "own_bin"):
        for tail in (("keep", "drop") if oversize == "truncate" else ("keep",)):
            expect = next_fit_decreasing(lengths, max_length, oversize, tail)
            assert plan_bins(lengths, max_length, tail) == expect


def test_fixture_example():
    lengths = [9, 5, 5, 5, 4, 3, 3, 2, 1, 1, 12]
    as_lengths = lambda bins: [[lengths[i] for i in b] for b in bins]
    assert as_lengths(next_fit_decreasing(lengths, 10, "own_bin")) == [[12], [9], [5, 5], [5, 4], [3, 3, 2, 1, 1]]
    assert as_lengths(next_fit_decreasing(lengths, 10, "truncate")) == [[12], [9], [5, 5], [5, 4], [3, 3, 2, 1, 1]]
    assert as_lengths(next_fit_decreasing(lengths, 10, "truncate", "drop")) == [[12], [9], [5, 5], [5, 4]]


def _frame(spark, groups):
    rows = []
    for g, lengths in groups.items():
        for i, n in enumerate(lengths):
            rows.append((g, i, n, [g * 1000 + i] * n))
    return spark.createDataFrame(rows, "g int, k long, length int, input_ids array<int>")


def _spark_bins(spark, groups, spec, **kw):
    df = _frame(spark, groups)
    assigned = assign_bins(df, spec, ["g"], "k").select("g", "k", "length", "bin").collect()
    out = {}
    for r in assigned:
        out.setdefault(r["g"], {}).setdefault(r["bin"], []).append((r["length"], r["k"]))
    return {g: [[k for _, k in sorted(m, key=lambda x: (-min(x[0], spec.max_length), -x[0], x[1]))]
                for _, m in sorted(bins.items())] for g, bins in out.items()}


def _groups(seed, n_groups=25, max_rows=30):
    rnd = random.Random(seed)
    return {g: [rnd.randint(1, 50) for _ in range(rnd.randint(1, max_rows))] for g in range(n_groups)}


def test_spark_assignment_equals_loop_many_groups(spark):
    groups = _groups(7)
    for spec in (PackSpec(20), PackSpec(20, "truncate", "drop"), PackSpec(20, "own_bin"), PackSpec(7)):
        got = _spark_bins(spark, groups, spec)
        for g, lengths in groups.items():
            expect = next_fit_decreasing(lengths, spec.max_length, spec.oversize, spec.tail)
            assert got.get(g, []) == expect, (spec, g)


def test_threshold_does_not_change_bins(spark):
    """A tiny per-task budget forces ordered ranges: the bins are the same."""
    groups = {0: [random.Random(3).randint(1, 9) for _ in range(400)], 1: [3] * 50, 2: [40] * 30 + [50, 45]}
    for mode in ("truncate", "own_bin"):
        got = _spark_bins(spark, groups, PackSpec(16, mode, tokens_per_task=40))
        for g, lengths in groups.items():
            assert got[g] == next_fit_decreasing(lengths, 16, mode), (mode, g)


def test_shuffle_join_path_when_plan_is_large(spark):
    groups = _groups(11, n_groups=10)
    spec = PackSpec(20, broadcast_rows=0)
    got = _spark_bins(spark, groups, spec)
    for g, lengths in groups.items():
        assert got[g] == next_fit_decreasing(lengths, 20)


def test_materialized_bins_invariants(spark):
    groups = _groups(5, n_groups=6)
    df = _frame(spark, groups)
    for spec in (PackSpec(20), PackSpec(20, "own_bin")):
        bins = materialize_bins(assign_bins(df, spec, ["g"], "k"), spec, ["g"]).collect()
        total = sum(min(n, 20) if spec.oversize == "truncate" else n for ls in groups.values() for n in ls)
        assert sum(b["length"] for b in bins) == total
        for b in bins:
            ids, labels, pos = b["input_ids"], b["labels"], b["position_ids"]
            assert len(ids) == len(labels) == len(pos) == b["length"]
            if spec.oversize == "truncate" or b["n_members"] > 1:
                assert b["length"] <= 20
            starts = [i for i, p in enumerate(pos) if p == 0]
            assert len(starts) == b["n_members"]
            assert all(labels[i] == -100 for i in starts)
            assert all(labels[i] == ids[i] for i in range(len(ids)) if i not in starts)


def test_bins_never_mix_groups(spark):
    groups = {0: [5, 5], 1: [5, 5]}
    spec = PackSpec(100)
    bins = materialize_bins(assign_bins(_frame(spark, groups), spec, ["g"], "k"), spec, ["g"]).collect()
    assert sorted((b["g"], b["n_members"]) for b in bins) == [(0, 2), (1, 2)]


def test_invalid_spec():
    import pytest

    with pytest.raises(ValueError):
        PackSpec(0)
    with pytest.raises(ValueError):
        PackSpec(10, "cut")


def test_only_heavy_groups_are_cut(spark):
    rnd = random.Random(9)
    groups = {0: [rnd.randint(1, 9) for _ in range(600)], 1: [3] * 10, 2: [rnd.randint(1, 9) for _ in range(8)]}
    got = _spark_bins(spark, groups, PackSpec(16, tokens_per_task=100))
    for g, lengths in groups.items():
        assert got[g] == next_fit_decreasing(lengths, 16)
