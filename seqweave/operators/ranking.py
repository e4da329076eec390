"""Dense numbering of rows inside groups, without one task per hot group.

``number_within`` gives every row an index ``_r`` in ``0..n-1`` inside its
group, in ascending order of one sort key.  A plain window partitioned by the
group would put a hot group, e.g. one file holding a third of all rows, into one
task.  Instead the group weights (already known from a histogram) decide:

* every group fits one task: a window over the group does it;
* otherwise the rows are range-partitioned by (group, sort key), a binary search among the range
  borders per row, and sorted inside each range.  A row's place in its range is its position there; the
  rows that its group has in earlier ranges, a running sum over one count per (group, range), are
  added.  A range border may fall anywhere inside a heavy group, so none is in one task.

Ranges follow the order, so the index does not depend on the threshold: it is
the index one window over the whole group would give.  NULL group keys are
groups like any other (all joins are null-safe).

The group table is joined with a broadcast only when its row count, checked
first, is under ``broadcast_rows``; otherwise it is a shuffle join on the
same keys the window partitions by, so the window adds no second exchange.
Its rows are narrow: a group's columns and two numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqweave.plans.stage import stage_table

DEFAULT_BROADCAST_ROWS = 1_000_000
# every range is a task whose metrics, and up to 300 sampled sort keys, come to the driver; ranges may be larger than a
# task's share instead, their rows are narrow and their sort spills
MAX_RANGES = 2_000


def maybe_broadcast(df: DataFrame, rows: int, limit: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a checked row count."""
    return F.broadcast(df) if rows <= limit else df


def group_stats(weight: Column) -> dict:
    """Metrics to observe while staging a group table (see ``stage_table``)."""
    return {"g": F.count(F.lit(1)), "w": F.max(weight), "t": F.sum(weight)}


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal ``keys``, NULL equal to NULL; the keys of ``left`` are kept."""
    other = right.select(*[F.col(c).alias(f"_rk_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [left[k].eqNullSafe(other[f"_rk_{k}"]) for k in keys]
    return left.join(other, on, how).drop(*[f"_rk_{k}" for k in keys])


def number_within(rows: DataFrame, groups: DataFrame, keys: list[str], sort_key: Column,
                  weight: Column, per_task: int,
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS, stats: dict | None = None) -> DataFrame:
    """Join ``groups`` (one staged row per key, with its columns) onto ``rows``
    and add ``_r``, the 0-based index of each row inside its group by ascending
    ``sort_key`` (one value, or a struct of several, that tells the group's rows apart).

    ``stats`` (``g``: groups, ``w``: heaviest weight, ``t``: their sum) may come from observing
    the staging write; otherwise they are computed from ``groups``.
    """
    if stats is None:
        stats = groups.agg(*[c.alias(k) for k, c in group_stats(weight).items()]).first().asDict()
    n_groups, heaviest, total = (int(stats[k] or 0) for k in ("g", "w", "t"))
    per_task = max(1, int(per_task))
    rows = rows.withColumn("_ord", sort_key)
    if heaviest <= per_task:
        w = Window.partitionBy(*keys).orderBy("_ord")
        numbered = rows.withColumn("_r", (F.row_number().over(w) - 1).cast("long")).drop("_ord")
        return join_null_safe(numbered, maybe_broadcast(groups, n_groups, broadcast_rows), keys)

    ranges = min(MAX_RANGES, -(-2 * total // per_task))
    # sorted ranges, written down: the id numbers the rows of each range
    placed = rows.repartitionByRange(ranges, *keys, "_ord").sortWithinPartitions(*keys, "_ord").drop("_ord")
    placed = stage_table(placed.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    runs = placed.groupBy(*keys, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_len"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*keys, "_range", (F.coalesce(F.sum("_len").over(before), F.lit(0)) - F.col("_first")).alias("_off"))
    # at most one row per group and one more per range border
    runs, seen = stage_table(join_null_safe(runs, maybe_broadcast(groups, n_groups, broadcast_rows), keys), "runs",
                             {"n": F.count(F.lit(1))})
    out = join_null_safe(placed, maybe_broadcast(runs, int(seen["n"] or 0), broadcast_rows), [*keys, "_range"])
    return out.withColumn("_r", (F.col("_at") + F.col("_off")).cast("long")).drop("_at", "_off", "_range")


def length_histogram(df: DataFrame, group_cols: list[str], length_col: str = "length") -> DataFrame:
    """Rows per (group, length): a partial + final hash aggregation."""
    return df.groupBy(*group_cols, length_col).agg(F.count(F.lit(1)).alias("n"))


def rank_by_length(df: DataFrame, group_cols: list[str], key_col: str, length_col: str = "length",
                   rows_per_task: int = 8_000_000,
                   broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """1-based rank of each row by (length desc, key asc) inside its group.

    The rank is (rows longer than this one in the group) + (index among rows of
    the same length).  The first part is a running sum over the group's length
    histogram (bounded by the number of distinct lengths); the second comes
    from ``number_within``.  No window ever spans a whole group of rows.
    """
    hist = df.groupBy(*group_cols, length_col).agg(F.count(F.lit(1)).alias("_n"))
    longer = Window.partitionBy(*group_cols).orderBy(F.col(length_col).desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    hist = hist.withColumn("_before", F.coalesce(F.sum("_n").over(longer), F.lit(0)))
    hist, stats = stage_table(hist, "length-offsets", group_stats(F.col("_n")))
    numbered = number_within(df, hist, [*group_cols, length_col], F.col(key_col),
                             F.col("_n"), rows_per_task, broadcast_rows, stats)
    return numbered.withColumn("rank", (F.col("_before") + F.col("_r") + 1).cast("long")).drop(
        "_n", "_before", "_r")
