"""Packing worked out from prefix sums, as an independent check of the plan."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate


def next_fit_decreasing(lengths, max_length: int, oversize: str = "truncate", tail: str = "keep") -> list[list[int]]:
    """Row numbers per bin, rows longest first (ties by number).

    A bin ends at the furthest place whose prefix sum is within ``max_length`` of the bin's start, but
    holds one row at least.  In truncate mode rows of ``max_length`` or more are bins of their own in
    front; ``tail="drop"`` leaves out the last bin of the others.
    """
    order = [i for _, i in sorted((-n, i) for i, n in enumerate(lengths))]
    full = sum(n >= max_length for n in lengths) if oversize == "truncate" else 0
    rest = order[full:]
    upto = [0, *accumulate(lengths[i] for i in rest)]
    cuts = [0]
    while cuts[-1] < len(rest):
        start = cuts[-1]
        cuts.append(max(start + 1, bisect_right(upto, upto[start] + max_length) - 1))
    bins = [rest[a:b] for a, b in zip(cuts, cuts[1:])]
    return [[i] for i in order[:full]] + (bins[:-1] if tail == "drop" else bins)
