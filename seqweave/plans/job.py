"""End-to-end packing job and its report.

``pack_conversations`` is the DataFrame-in / DataFrame-out core (no IO);
``pack_job`` adds the reader, staging and the sink, mirroring the reference's
command line (input, output, template, tokenizer, max_length, format).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seqweave.functions.fields import length_of
from seqweave.functions.template import ChatTemplate
from seqweave.functions.tokenizers import CodePointTokenizer
from seqweave.operators.packing import PackSpec, assign_staged, clip_payload, materialize_bins, with_bins
from seqweave.plans.stage import stage_parts, stage_table, stages_removed
from seqweave.sinks.arrow_stream import check_scheme, qualified
from seqweave.sinks.files import ONE_PART, bins_per_part_for, write_bins
from seqweave.sources.jsonl import conversations_from_lines


def tokenize_conversations(conv: DataFrame, template: ChatTemplate, tokenizer=None,
                           key_col: str = "row_key", group_cols: list[str] | None = None,
                           add_generation_prompt: bool = False,
                           zero_tokens: str = "fail") -> DataFrame:
    """Render + tokenize: ``group_cols, key, length, input_ids`` (+ ``prompt``).

    Expression tokenizers (code points) also keep ``prompt`` and compute
    ``length`` straight from the text, so passes that only need lengths never
    build token arrays (Catalyst prunes ``input_ids``), and bins can be
    tokenized after the shuffle (see ``materialize_bins(late_ids=...)``).

    A conversation that yields no token cannot be labelled (the reference
    indexes the first label); ``zero_tokens="fail"`` raises, ``"drop"``
    filters such rows out.
    """
    tokenizer = tokenizer or CodePointTokenizer()
    group_cols = list(group_cols or [])
    rendered = conv.select(*group_cols, key_col,
                           template.render("messages", add_generation_prompt).alias("prompt"))
    if hasattr(tokenizer, "ids") and hasattr(tokenizer, "length"):
        tok = rendered.select(*group_cols, key_col, tokenizer.length("prompt").alias("length"),
                              tokenizer.ids("prompt").alias("input_ids"), "prompt")
    else:
        tok = tokenizer.tokenize(rendered, "prompt", "input_ids", key_cols=[key_col])
        tok = tok.select(*group_cols, key_col, length_of("input_ids").alias("length"), "input_ids")
    # ``length`` is declared non-null (coalesce): otherwise Catalyst infers
    # isnotnull(length) for later joins and evaluates the rendering twice
    n = F.coalesce(F.col("length"), F.lit(0))
    if zero_tokens == "fail":
        checked = F.when(n == 0, F.raise_error(F.concat(
            F.lit("conversation renders to no tokens: "), F.col(key_col).cast("string")))
        ).otherwise(n)
        return tok.withColumn("length", F.coalesce(checked, F.lit(0)).cast("int"))
    return tok.withColumn("length", n.cast("int")).filter(F.col("length") > 0)


def pack_conversations(tokens: DataFrame, spec: PackSpec, group_cols: list[str] | None,
                       key_col: str, tokenizer=None) -> DataFrame:
    """Tokenized rows -> one row per bin (``input_ids, labels, position_ids, length``).

    The rows are staged once; bins are worked out on the narrow columns and the payload is shuffled once."""
    late = _late_ids(tokens, tokenizer)
    staged = _staged_payload(tokens, spec, tokenizer, late)
    assigned = assign_staged(staged, spec, group_cols, key_col)
    return materialize_bins(with_bins(staged, assigned, spec), spec, group_cols, late_ids=late)


def _staged_payload(tokens: DataFrame, spec: PackSpec, tokenizer, late, parts: int = 0) -> DataFrame:
    """Text + length for expression tokenizers, ids otherwise, cut to ``max_length`` in truncate mode."""
    head = getattr(tokenizer or CodePointTokenizer(), "head", None) if late else None
    return stage_parts(clip_payload(tokens.drop("input_ids") if late else tokens, spec, head=head), "tokens", parts)


def _late_ids(tokens: DataFrame, tokenizer):
    tokenizer = tokenizer or CodePointTokenizer()
    if "prompt" in tokens.columns and hasattr(tokenizer, "ids"):
        return tokenizer.ids
    return None


def pack_report(assigned: DataFrame, spec: PackSpec, group_cols: list[str]) -> DataFrame:
    """Per group: rows, bins, tokens in and out, truncated and dropped tokens,
    fill rate.

    Built from the bin assignment only (no arrays); a two-level aggregation
    (per bin, then per group) avoids a distinct count over rows.  Rows flagged
    ``dropped`` (``assign_bins(mark_dropped=True)``) count as dropped tokens
    and are left out of bins and packed tokens.
    """
    m = int(spec.max_length)
    kept = F.least(F.col("length"), F.lit(m)) if spec.oversize == "truncate" else F.col("length")
    lost = F.col("dropped") if "dropped" in assigned.columns else F.lit(False)
    per_bin = assigned.groupBy(*group_cols, "bin").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(kept).alias("_tokens"),
        F.sum("length").alias("_input"),
        F.max(lost).alias("_lost"),
    )
    out_tokens = F.sum(F.when(~F.col("_lost"), F.col("_tokens")).otherwise(F.lit(0)))
    out_bins = F.sum(F.when(~F.col("_lost"), F.lit(1)).otherwise(F.lit(0)))
    return per_bin.groupBy(*group_cols).agg(
        F.sum("_rows").cast("long").alias("rows"),
        out_bins.cast("long").alias("bins"),
        F.sum("_input").cast("long").alias("input_tokens"),
        out_tokens.cast("long").alias("packed_tokens"),
        (F.sum("_input") - F.sum("_tokens")).cast("long").alias("truncated_tokens"),
        F.sum(F.when(F.col("_lost"), F.col("_tokens")).otherwise(F.lit(0))).cast("long").alias("dropped_tokens"),
        F.round(F.try_divide(out_tokens, out_bins * F.lit(m)), 6).alias("fill_rate"),
        # tokens of the fullest and emptiest bins, from a mergeable sketch in the same aggregation
        F.percentile_approx(F.when(~F.col("_lost"), F.col("_tokens")), [0.1, 0.5, 0.9], 10_000).alias("bin_tokens_p10_p50_p90"),
    )


def pack_job(spark: SparkSession, input_path: str, output_path: str,
             template: ChatTemplate | None = None, tokenizer=None, max_length: int = 8192,
             fmt: str = "arrow", tail: str = "keep", on_error: str = "fail",
             oversize: str | None = None, layout: str = "parts",
             add_generation_prompt: bool = False) -> dict:
    """Folder (or file) of JSONL conversations -> packed bins per input file.

    ``fmt`` is ``arrow`` (default; truncates over-long rows), ``jsonl``
    (keeps them whole in their own bin) or ``parquet``; case-insensitive, an
    unknown value raises.  Bins never mix input files.  The tokenized rows are
    staged once in the checkpoint folder; histogram and numbering read its
    narrow columns, and the text is shuffled once, to its bins.
    """
    from seqweave.sources.jsonl import folder_stems, read_lines

    return pack_lines(read_lines(spark, input_path), output_path, template, tokenizer, max_length,
                      fmt, tail, on_error, oversize, layout,
                      add_generation_prompt=add_generation_prompt, stems=folder_stems(spark, input_path))


def pack_lines(lines: DataFrame, output_path: str, template: ChatTemplate | None = None,
               tokenizer=None, max_length: int = 8192, fmt: str = "arrow", tail: str = "keep",
               on_error: str = "fail", oversize: str | None = None, layout: str = "parts",
               part_prefix: str = "", add_generation_prompt: bool = False,
               stems: DataFrame | None = None) -> dict:
    """``pack_job`` on already listed lines (``source_file, file_stem, line``).

    ``stems`` (``file_stem``) names all input files, so that files without
    lines get an output too.  Tables staged on the way are removed at the
    end; the report is a small staged table that stays.

    Returns ``report``, ``spec`` and ``quantiles`` of the tokens of conversations and bins and the members of
    bins, from mergeable sketches observed while the tables are written (rank error ``RANK_ERROR``).
    """
    fmt = fmt.lower()
    if fmt not in ("arrow", "jsonl", "parquet"):
        raise ValueError(f"format not supported: {fmt}")
    if oversize is None:
        oversize = "own_bin" if fmt == "jsonl" else "truncate"
    spec = PackSpec(max_length, oversize, tail)
    if fmt != "parquet":
        check_scheme(qualified(lines.sparkSession, output_path))
    with stages_removed(lines.sparkSession):
        report, quantiles = _pack_staged(lines, output_path, template or ChatTemplate.sections(),
                                         tokenizer or CodePointTokenizer(), spec, fmt, on_error, layout, part_prefix,
                                         add_generation_prompt, stems)
    return {"report": report, "spec": spec, "quantiles": quantiles}


QUANTILES = (0.01, 0.1, 0.5, 0.9, 0.99)
RANK_ERROR = 1e-4  # of the quantile sketches, as a share of the rows


def _observed(df: DataFrame, **columns: str):
    """``df`` with quantile sketches of its columns observed while it is written, and the observation."""
    seen = Observation(f"quantiles-{uuid.uuid4().hex[:8]}")
    return df.observe(seen, *[F.percentile_approx(c, list(QUANTILES), int(1 / RANK_ERROR)).alias(name)
                              for name, c in columns.items()]), seen


def _quantiles(*observations) -> dict:
    """Name -> quantile -> value (None without rows)."""
    values = {k: v for seen in observations for k, v in seen.get.items()}
    return {k: dict(zip(QUANTILES, v or [None] * len(QUANTILES))) for k, v in values.items()}


def _pack_staged(lines, output_path, template, tokenizer, spec, fmt, on_error, layout, part_prefix,
                 add_generation_prompt, stems) -> tuple[DataFrame, dict]:
    conv = conversations_from_lines(lines, on_error)
    rejected = None
    if on_error == "quarantine":
        conv, rejected = conv
    elif not hasattr(tokenizer, "ids"):
        # a tokenizer job reads the rows more than once: fix their keys first
        conv = stage_table(conv, "conversations")
    groups = ["source_file", "file_stem"]
    tokens = tokenize_conversations(conv, template, tokenizer, "row_key", groups, add_generation_prompt)
    late = _late_ids(tokens, tokenizer)
    tokens, lengths = _observed(tokens, conversation_tokens="length")
    staged = _staged_payload(tokens, spec, tokenizer, late, lines.rdd.getNumPartitions())
    assigned = assign_staged(staged, spec, groups, "row_key")
    report = stage_table(pack_report(assigned, spec, groups), "report", keep=True)
    empty = report.filter("bins = 0").select("file_stem") if spec.tail == "drop" else None
    if stems is not None:
        # input files without a (good) conversation
        unread = stems.join(report.select("file_stem"), "file_stem", "left_anti")
        empty = unread if empty is None else empty.unionByName(unread)
    per_part = ONE_PART if layout == "file" else bins_per_part_for(spec.max_length)
    bins = materialize_bins(with_bins(staged, assigned, spec), spec, groups, late_ids=late, bins_per_part=per_part)
    bins, fills = _observed(bins, bin_tokens="length", bin_members="n_members")
    write_bins(bins, output_path, fmt, layout=layout, part_prefix=part_prefix, clustered=True,
               bins_per_part=per_part, empty=empty)
    if rejected is not None:
        rejected.write.mode("overwrite").json(output_path.rstrip("/") + "/_rejected")
    return report, _quantiles(lengths, fills)
