"""Cross-site boilerplate lines by distinct-site spread.

1. Lines are cut once into a narrow staged table (document key, line number,
   line hash, site hash, length).
2. A plain hash aggregation drops lines that cannot spread: seen fewer than
   ``min_sites`` times or on one site only.
3. For the rest, HyperLogLog sketches of the sites are built per line hash by
   partial aggregation and merged (``hll_sketch_agg``).  An estimate of at
   least twice ``min_sites`` (under half of it) settles the line; the lines
   between get an exact distinct count.
4. Lines on ``min_sites`` or more sites are boilerplate and are removed from
   every document.

A line must also be in ``min_texts`` distinct texts, so the lines of one text that stands
on many sites are left to near-duplicate removal.  Boilerplate goes whatever its share of a document.

The narrow lines meet the line lists by ``join_heads``: a line that holds a third of all rows is in no task in bulk.

Lines are compared without leading and trailing blanks; blank lines are never
boilerplate.  A NULL site counts as one site of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqweave.llm.common import join_heads
from seqweave.plans.stage import stage_table

BROADCAST_LINES = 200_000  # 8 bytes each; a longer list of boilerplate lines is joined by shuffle
LG_K = 12  # sketch size: 4096 registers, 1.6 % standard error


def line_table(docs: DataFrame, site_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, _key, _no, _hash, _site, _chars`` per line; blank lines have a NULL hash."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
                       F.xxhash64(F.col(site_col).cast("string")).alias("_site"))
    cut = rows.select("_id", F.xxhash64("_text").alias("_key"), "_site",
                      F.posexplode(F.split("_text", "\n", -1)).alias("_no", "_line"))
    line = F.trim("_line")
    return cut.select("_id", "_key", "_site", "_no", F.char_length("_line").alias("_chars"),
                      F.when(line != "", F.xxhash64(line)).alias("_hash"))


def spread_lines(lines: DataFrame, min_sites: int, min_texts: int, n_lines: int) -> DataFrame:
    """``_hash, _n``: the lines on at least ``min_sites`` sites, in ``min_texts`` texts, with their rows.

    ``lines`` is a staged table of ``n_lines`` rows."""
    known = lines.filter(F.col("_hash").isNotNull())

    def rows_of(heads: DataFrame, *cols: str) -> DataFrame:
        return join_heads(known.select("_hash", *cols), heads.select("_hash", "_n"), "_hash", n_lines)

    seen = known.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"), F.min("_site").alias("_lo"),
                                      F.max("_site").alias("_hi"))
    likely = seen.filter((F.col("_n") >= min_sites) & ((F.col("_lo") != F.col("_hi")) | F.lit(min_sites <= 1)))
    likely = stage_table(likely.select("_hash", "_n"), "likely-lines")
    sketches = rows_of(likely, "_site").groupBy("_hash").agg(F.hll_sketch_agg("_site", F.lit(LG_K)).alias("_sk"))
    about = sketches.select("_hash", F.hll_sketch_estimate("_sk").alias("_about")).join(likely, "_hash")
    about = stage_table(about, "line-spread")
    sure = about.filter(F.col("_about") >= 2 * min_sites).select("_hash", "_n")
    near = about.filter((F.col("_about") < 2 * min_sites) & (F.col("_about") * 2 >= min_sites))
    # distinct (line, site) pairs first, so a very common line is reduced before it is counted
    counts = rows_of(near, "_site").distinct().groupBy("_hash").agg(F.count(F.lit(1)).alias("_exact"))
    spread = sure.unionByName(near.join(counts.filter(F.col("_exact") >= min_sites), "_hash").select("_hash", "_n"))
    if min_texts <= 1:
        return spread
    spread = stage_table(spread, "spread-lines")
    texts = rows_of(spread, "_key").distinct().groupBy("_hash").agg(F.count(F.lit(1)).alias("_texts"))
    return spread.join(texts.filter(F.col("_texts") >= min_texts).select("_hash"), "_hash", "left_semi")


def mark_boilerplate(docs: DataFrame, site_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
                     min_sites: int = 10, min_texts: int = 10, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """One row per row of ``docs``: ``_doc`` (all its columns as a struct), ``_id``, ``_new`` (the text
    without boilerplate; NULL text stays NULL), ``n_lines, n_boilerplate``."""
    lines, all_lines = stage_table(line_table(docs, site_col, id_col, text_col), "lines", {"n": F.count(F.lit(1))})
    n_lines = int(all_lines["n"] or 0)
    flagged, seen = stage_table(spread_lines(lines, min_sites, min_texts, n_lines), "boilerplate",
                                {"n": F.count(F.lit(1))})
    if int(seen["n"] or 0) <= broadcast_lines:
        hits = lines.join(F.broadcast(flagged.select("_hash")), "_hash")
    else:
        hits = join_heads(lines, flagged, "_hash", n_lines)
    # identical rows of one document repeat the same line numbers: a set keeps each once
    marks = hits.groupBy("_id", "_key").agg(
        F.sort_array(F.collect_set(F.struct("_no", "_chars"))).alias("_hits")).select(
        F.col("_id").alias("_mid"), F.col("_key").alias("_mkey"), F.col("_hits._no").alias("_nos"))
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                      F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    both = src.join(marks, F.col("_id").eqNullSafe(F.col("_mid"))
                    & (F.xxhash64(F.coalesce("_text", F.lit(""))) == F.col("_mkey")), "left")
    both = both.select("_doc", "_id", "_text", "_nos",
                       F.split(F.coalesce("_text", F.lit("")), "\n", -1).alias("_parts"))
    n_hit = F.when(F.col("_nos").isNull(), 0).otherwise(F.size("_nos"))
    # the kept lines are the runs between removed line numbers (both lists are sorted: linear work)
    bounds = F.concat(F.array(F.lit(-1)), F.col("_nos"), F.array(F.size("_parts")))
    runs = F.zip_with(F.slice(bounds, F.lit(1), n_hit + 1), F.slice(bounds, F.lit(2), n_hit + 1),
                      lambda a, b: F.slice(F.col("_parts"), a + 2, b - a - 1))
    return both.select("_doc", "_id",
                       F.when(n_hit > 0, F.array_join(F.flatten(runs), "\n")).otherwise(F.col("_text")).alias("_new"),
                       F.size("_parts").alias("n_lines"), n_hit.alias("n_boilerplate"))


def remove_boilerplate(docs: DataFrame, site_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
                       min_sites: int = 10, min_texts: int = 10, **options) -> DataFrame:
    """All rows and columns of ``docs`` with the boilerplate lines taken out of ``text_col``."""
    marked = mark_boilerplate(docs, site_col, id_col, text_col, min_sites, min_texts, **options)
    return marked.select(*[F.col("_new").alias(c) if c == text_col else F.col(f"_doc.`{c}`").alias(c)
                           for c in docs.columns])
