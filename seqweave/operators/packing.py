"""Exact next-fit-decreasing packing as distributed DataFrame jobs.

1. ``_L = least(length, max_length)``; histogram of ``_L`` per group
   (partial + final hash aggregation over narrow columns).
2. Plan: a walk over each group's histogram (at most ``max_length`` rows),
   many groups per task -> ``(_b0, _k0, _per, _tail)`` per length.
   The plan is staged in the checkpoint folder so the histogram runs once.
3. Every row gets its index ``_r`` among rows of equal ``_L`` in its group
   (``number_within``: in ordered ranges when a group is too heavy for one task) and
   then its bin by arithmetic.  Over-long rows need no branch: clamped to
   ``max_length`` they fill a bin each.
   ``assign_staged`` does all this on the narrow columns of a staged table, and
   ``with_bins`` puts the result beside the payload where it lies, so text or
   ids are shuffled once, to their bins.
4. ``materialize_bins`` concatenates the members of each bin; a bin holds at
   most ``max_length`` tokens (or one over-long row), so no group is unbounded.

Modes: ``oversize="truncate"`` cuts over-long rows to ``max_length`` (the
reference's Arrow path), ``"own_bin"`` keeps them whole in their own bin (its
JSONL path).  ``tail="drop"`` removes each group's last bin of short rows, as
the reference's Arrow path loses it; ``"keep"`` (default) keeps every row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seqweave.functions.fields import labels_for, position_ids_for
from seqweave.operators.ranking import DEFAULT_BROADCAST_ROWS, group_stats, number_within
from seqweave.plans.nfd import walk_batches
from seqweave.plans.stage import beside_parts, stage_table
from seqweave.session import ship_package

_PLAN_COLS = ["_n", "_b0", "_k0", "_per", "_tail"]
_GROUP = "_group"


@dataclass(frozen=True)
class PackSpec:
    max_length: int = 8192
    oversize: str = "truncate"  # "truncate" | "own_bin"
    tail: str = "keep"  # "keep" | "drop"
    tokens_per_task: int = 64_000_000
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS

    def __post_init__(self):
        if int(self.max_length) <= 0:
            raise ValueError("max_length must be positive")
        if self.oversize not in ("truncate", "own_bin"):
            raise ValueError("oversize must be 'truncate' or 'own_bin'")
        if self.tail not in ("keep", "drop"):
            raise ValueError("tail must be 'keep' or 'drop'")

    @staticmethod
    def arrow_parity(max_length: int = 8192) -> PackSpec:
        return PackSpec(max_length, "truncate", "drop")

    @staticmethod
    def jsonl_parity(max_length: int = 8192) -> PackSpec:
        return PackSpec(max_length, "own_bin", "keep")


def _groups(df: DataFrame, group_cols: list[str] | tuple[str, ...] | None):
    if group_cols:
        return df, list(group_cols)
    return df.withColumn(_GROUP, F.lit("")), [_GROUP]


def _weight():
    return F.col("_n") * F.col("_L")


def pack_plan(rows: DataFrame, spec: PackSpec, group_cols: list[str]):
    """Histogram of clamped lengths per group, walked into a staged plan.

    Returns ``(plan, stats)``; the stats (plan rows, heaviest group in
    tokens) are observed while the plan is written."""
    ship_package(rows.sparkSession)
    hist = rows.groupBy(*group_cols, "_L").agg(F.count(F.lit(1)).alias("_n"))
    schema = T.StructType(
        hist.schema.fields
        + [T.StructField(c, T.LongType()) for c in ("_b0", "_k0", "_per", "_tail")]
    )
    # many files a task, each file's lengths in a row
    order = [F.col(c).asc_nulls_first() for c in group_cols]
    walked = hist.repartition(*group_cols).sortWithinPartitions(*order, F.col("_L").desc())
    plan = walked.mapInArrow(walk_batches(to_arrow_schema(schema), group_cols, int(spec.max_length)), schema)
    return stage_table(plan, "pack-plan", group_stats(_weight()))


def assign_bins(df: DataFrame, spec: PackSpec, group_cols: list[str] | None, key_col: str,
                length_col: str = "length", mark_dropped: bool = False) -> DataFrame:
    """Add ``bin`` (0-based, in creation order inside the group) to every row.

    Also keeps ``_L`` (clamped length) and ``_r`` (index among equal ``_L``),
    which ``materialize_bins`` uses to order the members of a bin.  With
    ``tail="drop"`` the rows of each group's last short-row bin are removed,
    or, with ``mark_dropped``, kept and flagged in a boolean ``dropped``
    column (so a report can count them).
    """
    df, keys = _groups(df, group_cols)
    m = int(spec.max_length)
    rows = df.withColumn("_L", F.least(F.col(length_col), F.lit(m)).cast("int"))
    plan, stats = pack_plan(rows, spec, keys)
    numbered = number_within(
        rows, plan, [*keys, "_L"], F.struct(-F.col(length_col), F.col(key_col)),
        _weight(), spec.tokens_per_task, spec.broadcast_rows, stats)
    fresh = F.col("_b0") + 1 + F.expr("(_r - _k0) div _per")
    out = numbered.withColumn(
        "bin", F.when(F.col("_r") < F.col("_k0"), F.col("_b0")).otherwise(fresh).cast("long"))
    if spec.tail == "drop":
        lost = F.coalesce(F.col("bin") == F.col("_tail"), F.lit(False))
        out = out.withColumn("dropped", lost) if mark_dropped else out.filter(~lost)
    out = out.drop(*_PLAN_COLS)
    return out.drop(_GROUP) if _GROUP in out.columns else out


def assign_staged(staged: DataFrame, spec: PackSpec, group_cols: list[str] | None, key_col: str) -> DataFrame:
    """Bins of a table staged by ``stage_parts``, from its narrow columns only.

    One staged row per input row: ``groups, length, bin, dropped, _r, _part, _pos``; no payload goes through the
    histogram, the numbering or the joins of the plan.
    """
    cols = list(group_cols or [])
    narrow = staged.select(*cols, key_col, "length", "_part", "_pos")
    assigned = assign_bins(narrow, spec, group_cols, key_col, mark_dropped=True)
    if "dropped" not in assigned.columns:
        assigned = assigned.withColumn("dropped", F.lit(False))
    return stage_table(assigned.select(*cols, "length", "bin", "dropped", "_r", "_part", "_pos"), "assigned")


def with_bins(staged: DataFrame, assigned: DataFrame, spec: PackSpec) -> DataFrame:
    """The staged rows with ``bin``, ``_r`` and ``_L`` put beside them in place; rows of lost bins left out."""
    rows = beside_parts(staged, assigned, ["bin", "_r", "dropped"])
    clamped = F.least(F.col("length"), F.lit(int(spec.max_length))).cast("int")
    return rows.filter(~F.col("dropped")).drop("dropped").withColumn("_L", clamped)


def clip_payload(tokens: DataFrame, spec: PackSpec, ids_col: str = "input_ids",
                 text_col: str = "prompt", head=None) -> DataFrame:
    """In truncate mode, cut each row's payload to ``max_length`` tokens before
    any shuffle: ids are sliced; text is cut with ``head`` (a prefix-stable
    tokenizer's ``head(text, n)``) when given.  ``length`` keeps the true
    count, which orders over-long rows and feeds the report."""
    if spec.oversize != "truncate":
        return tokens
    m = int(spec.max_length)
    out = tokens
    if ids_col in out.columns:
        out = out.withColumn(ids_col, F.slice(F.col(ids_col), 1, m))
    if head is not None and text_col in out.columns:
        out = out.withColumn(text_col, head(F.col(text_col), m))
    return out


def materialize_bins(assigned: DataFrame, spec: PackSpec, group_cols: list[str] | None,
                     ids_col: str = "input_ids", late_ids=None, text_col: str = "prompt",
                     bins_per_part: int | None = None) -> DataFrame:
    """One row per bin: members concatenated in pop order (longest first).

    Only one payload column travels through the shuffle: the token ids, or,
    with ``late_ids`` (a text -> ids Column function such as the code-point
    tokenizer), the text itself, tokenized per member after grouping; text is
    the smaller of the two.  Labels and positions are rebuilt per member, so
    each member's first label is -100 and its positions restart at 0, which
    marks the conversation boundaries.

    ``bins_per_part`` clusters the output for writing: rows are shuffled on
    (group, bin // bins_per_part) and grouped on (group, that bucket, bin),
    which the same hash partitioning satisfies, so a sink can write each
    partition as it is (one part per group and bucket) without a further
    shuffle of the packed arrays.
    """
    assigned, keys = _groups(assigned, group_cols)
    payload = F.col(text_col) if late_ids is not None else F.col(ids_col)
    member = F.struct((-F.col("_L")).alias("_o"), F.col("_r").alias("_r"), payload.alias("p"))
    by = [*keys, "bin"]
    if bins_per_part:
        assigned = assigned.withColumn("_part", F.expr(f"bin div {int(bins_per_part)}"))
        assigned = assigned.repartition(*keys, "_part")
        by = [*keys, "_part", "bin"]
    grouped = assigned.groupBy(*by).agg(F.array_sort(F.collect_list(member)).alias("_m"))
    m = int(spec.max_length)

    def ids(x):
        return late_ids(x["p"]) if late_ids is not None else x["p"]

    if spec.oversize == "truncate":
        pieces = F.transform("_m", lambda x: F.slice(ids(x), 1, m))
    else:
        pieces = F.transform("_m", ids)
    out = grouped.select(*keys, "bin", F.size("_m").alias("n_members"), pieces.alias("_p"))
    out = out.select(
        *keys, "bin", "n_members",
        F.flatten("_p").alias("input_ids"),
        F.flatten(F.transform("_p", labels_for)).alias("labels"),
        F.flatten(F.transform("_p", position_ids_for)).alias("position_ids"),
    ).withColumn("length", F.size("input_ids").cast("int"))
    return out.drop(_GROUP) if _GROUP in out.columns else out
