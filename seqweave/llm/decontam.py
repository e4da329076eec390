"""Benchmark decontamination with a broadcast hash set of benchmark n-grams.

Words are runs of characters other than ASCII punctuation, control characters
and blanks, with A-Z lower-cased.  The benchmark side is a table of its
distinct windows of ``n`` consecutive words (an item of fewer words, but not
none, is one window of its own length) with a 64-bit hash and the ids of the
items that hold the window.  Documents are scanned once: every window is
hashed inside whole-stage code and probed against the hash set; a hash hit is
verified by comparing the words themselves, then the hit windows of a document
are merged into hit words.

The hash set is broadcast while it has at most ``broadcast_windows`` rows
(counted first); a larger benchmark is joined by shuffle on the salted window hash.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqweave.llm.common import lower_ascii
from seqweave.plans.stage import stage_table

NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value: what separates words, after lower-casing

SALTS = 16


def words(text: Column) -> Column:
    """The text's words in order (empty for NULL)."""
    split = F.split(lower_ascii(F.coalesce(text, F.lit(""))), NON_WORD)
    return F.filter(split, lambda w: w != "")


def benchmark_windows(benchmark: DataFrame, n: int = 10, item_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """``_len, _whash, _window, _items``: one row per distinct window.  Items with the same id and
    repeated items are merged; items with NULL id are named ``null``."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("_item"),
                             words(F.col(text_col)).alias("_w")).filter(F.size("_w") > 0)
    sized = items.withColumn("_len", F.least(F.size("_w"), F.lit(n)))
    each = sized.select("_item", "_len", "_w", F.explode(F.sequence(F.lit(1), F.size("_w") - F.col("_len") + 1)).alias("_at"))
    win = each.select("_item", "_len", F.slice("_w", F.col("_at"), F.col("_len")).alias("_win"))
    return win.groupBy("_len", F.xxhash64("_win").alias("_whash"), F.array_join("_win", " ").alias("_window")).agg(
        F.sort_array(F.collect_set("_item")).alias("_items"))


def _start(at: Column, size: int) -> Column:
    return F.struct(F.lit(size).alias("l"), at.cast("int").alias("at"))


def _starts(size: int) -> Column:
    """The starts of a document's windows of ``size`` words."""
    some = F.transform(F.sequence(F.lit(1), F.col("n_words") - (size - 1)), lambda i: _start(i, size))
    return F.when(F.col("n_words") >= size, some).otherwise(F.array().cast("array<struct<l:int,at:int>>"))


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", bench_text_col: str = "text", broadcast_windows: int = 500_000) -> DataFrame:
    """Per distinct (id, text): ``_id, _key, n_words, _hits`` (sorted 0-based word numbers that are hit)
    and ``_items`` (sorted ids of the items found).  An empty benchmark gives no hits."""
    grams, seen = stage_table(benchmark_windows(benchmark, n, item_col, bench_text_col), "bench-windows",
                              {"n": F.count(F.lit(1)), "lens": F.collect_set("_len")})
    lens = sorted(seen["lens"] or [])  # at most n different lengths
    count = int(seen["n"] or 0)
    src = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_key"),
                      words(F.col(text_col)).alias("_w"))
    src = src.withColumn("n_words", F.size("_w"))
    if count > broadcast_windows:
        return _scan_by_shuffle(src, grams, lens)
    # one row per window start and window length; start 0 stands for the document itself
    rows = _window_rows(src, lens, True).withColumn("_h", F.when(F.col("_at") > 0, F.xxhash64(_window())))
    found = rows.join(F.broadcast(grams), F.col("_h") == F.col("_whash"), "left")
    # verification, for hash hits only: the words themselves must agree
    same = (F.col("_l") == F.col("_len")) & (F.array_join(_window(), " ") == F.col("_window"))
    found = found.filter((F.col("_at") == 0) | (F.col("_whash").isNotNull() & same))
    return _per_document(found, F.col("_whash").isNotNull())


def _window() -> Column:
    return F.slice("_w", F.greatest(F.col("_at"), F.lit(1)), F.col("_l"))


def _window_rows(src: DataFrame, lens: list[int], marker: bool) -> DataFrame:
    """``_id, _key, n_words, _w, _at, _l``; with ``marker`` one row more per document, at 0."""
    own = ["_id", "_key", "n_words", "_w"]
    if len(lens) > 1:
        first = [F.array(_start(F.lit(0), 0))] if marker else []
        each = src.select(*own, F.explode(F.flatten(F.array(*first, *[_starts(k) for k in lens]))).alias("_s"))
        return each.select(*own, F.col("_s.at").alias("_at"), F.col("_s.l").alias("_l"))
    k = lens[0] if lens else 1 << 30
    last = F.col("n_words") - (k - 1)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), last)) if marker else F.when(
        last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return src.select(*own, F.explode(starts).alias("_at")).withColumn("_l", F.lit(k))


def _per_document(found: DataFrame, is_hit: Column) -> DataFrame:
    hit = F.when(is_hit, F.struct(F.col("_at").alias("at"), F.col("_len").alias("l")))
    out = found.groupBy("_id", "_key").agg(
        F.max("n_words").alias("n_words"), F.sort_array(F.collect_set(hit)).alias("_h"),
        F.flatten(F.collect_set("_items")).alias("_i"))
    covered = F.flatten(F.transform("_h", lambda x: F.sequence(x["at"] - 1, x["at"] + x["l"] - 2)))
    return out.select("_id", "_key", "n_words", F.array_distinct(covered).alias("_hits"),
                      F.sort_array(F.array_distinct("_i")).alias("_items"))


def _scan_by_shuffle(src: DataFrame, grams: DataFrame, lens: list[int]) -> DataFrame:
    """For a benchmark beyond the broadcast limit: only hashes and places of windows are shuffled; words go along for
    documents with hash hits alone.  The hashes are dealt ``SALTS`` times, so a window that a third of all
    documents hold is shared by that many tasks."""
    salt = F.pmod(F.xxhash64("_id", "_key", "_at"), F.lit(SALTS))
    narrow = _window_rows(src, lens, False).select("_id", "_key", "_at", "_l", F.xxhash64(_window()).alias("_h"), salt.alias("_salt"))
    hashes = grams.select(F.col("_whash").alias("_h")).distinct().withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    hits = narrow.join(hashes, ["_h", "_salt"]).groupBy("_id", "_key").agg(
        F.collect_set(F.struct("_at", "_l")).alias("_s"))
    hits = hits.select(F.col("_id").alias("_hid"), F.col("_key").alias("_hkey"), "_s")
    here = F.col("_id").eqNullSafe(F.col("_hid")) & (F.col("_key") == F.col("_hkey"))
    words_of = src.join(hits, here).select("_id", "_key", "n_words", "_w", F.explode("_s").alias("_s"))
    texts = words_of.select("_id", "_key", "n_words", "_w", "_s._at", "_s._l").select(
        "_id", "_key", "n_words", "_at", F.array_join(_window(), " ").alias("_window"), F.xxhash64(_window()).alias("_whash"))
    texts = texts.withColumn("_salt", F.pmod(F.xxhash64("_id", "_key", "_at"), F.lit(SALTS)))
    dealt = grams.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    found = _per_document(texts.join(dealt, ["_whash", "_window", "_salt"]), F.lit(True)).drop("n_words")
    found = found.withColumnsRenamed({"_id": "_fid", "_key": "_fkey"})
    every = src.select("_id", "_key", "n_words").distinct()
    both = every.join(found, F.col("_id").eqNullSafe(F.col("_fid")) & (F.col("_key") == F.col("_fkey")), "left")
    return both.select("_id", "_key", "n_words", F.coalesce("_hits", F.array().cast("array<int>")).alias("_hits"),
                       F.coalesce("_items", F.array().cast("array<string>")).alias("_items"))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: ``_doc`` (its columns as a struct), ``_id, _text, n_words, _hits, _items``."""
    marks = scan(docs, benchmark, n, id_col, text_col, **options).select(
        F.col("_id").alias("_mid"), F.col("_key").alias("_mkey"), "n_words", "_hits", "_items")
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                      F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    key = F.xxhash64(F.coalesce("_text", F.lit("")))
    return src.join(marks, F.col("_id").eqNullSafe(F.col("_mid")) & (key == F.col("_mkey"))).drop("_mid", "_mkey")


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, mode: str = "documents",
                  id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without its contaminated parts, all columns kept.

    ``mode="documents"`` drops every document with a hit; ``"spans"`` removes the hit words and the
    separators after them, and keeps the rest of the text as it stands.
    """
    if mode not in ("documents", "spans"):
        raise ValueError("mode must be 'documents' or 'spans'")
    hit = contamination(docs, benchmark, n, id_col, text_col, **options)
    columns = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns]
    if mode == "documents":
        return hit.filter(F.size("_hits") == 0).select(*columns)
    # words and the separators around them, in the original spelling: _sep[0] w0 _sep[1] w1 ...
    letter = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    parts = hit.withColumn("_words", F.filter(F.split("_text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != ""))
    parts = parts.withColumn("_rest", F.split("_text", letter, -1))
    units = F.zip_with("_words", F.slice("_rest", F.lit(2), F.size("_words")), lambda w, r: F.concat(w, r))
    parts = parts.withColumn("_units", units).withColumn("_n", F.size("_hits"))
    # the kept words are the runs between hits (both lists are sorted: linear work)
    bounds = F.concat(F.array(F.lit(-1)), F.col("_hits"), F.array(F.size("_words")))
    runs = F.zip_with(F.slice(bounds, F.lit(1), F.col("_n") + 1), F.slice(bounds, F.lit(2), F.col("_n") + 1),
                      lambda a, b: F.slice(F.col("_units"), a + 2, b - a - 1))
    text = F.concat(F.get("_rest", F.lit(0)), F.array_join(F.flatten(runs), ""))
    new = F.when(F.size("_hits") > 0, text).otherwise(F.col("_text"))
    return parts.select(*[new.alias(c) if c == text_col else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
