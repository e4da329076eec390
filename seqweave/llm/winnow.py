"""Document fingerprints by winnowing.

The ``k``-grams are runs of ``k`` consecutive words (blank-separated).  Each gets a hash; of every
``w`` consecutive hashes the smallest is chosen, the rightmost of equal ones, and kept with its
position.  Any run of ``w + k - 1`` words that two texts share holds a chosen gram in both, and a
gram is never chosen for a run shorter than ``k`` (texts of fewer words have one gram: all of them).

A gram's hash (39 bits) and its complemented position (24 bits) form one positive number, so that
``array_min`` over a window is the rightmost minimum; positions are exact up to 16,777,215 words and
wrap beyond.  Texts without words have the empty fingerprint.

Only DataFrame functions are used; a text is processed in its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"
_POS = (1 << 24) - 1
_HASH = (1 << 39) - 1


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS, -1), lambda w: w != "")


def chosen(words_col: str, k: int, w: int) -> Column:
    """The chosen grams of a words column as packed numbers, in text order without repeats."""
    n = F.size(words_col)
    k_here = F.least(n, F.lit(k))
    grams = F.transform(F.sequence(F.lit(1), n - k_here + 1), lambda i: F.shiftleft(
        F.xxhash64(F.slice(words_col, i, k_here)).bitwiseAND(F.lit(_HASH)), 24) + (
        F.lit(_POS) - F.pmod(i - 1, F.lit(_POS + 1))))
    return F.when(n > 0, grams).otherwise(F.array().cast("array<bigint>"))


def windows(grams_col: str, w: int) -> Column:
    m = F.size(grams_col)
    w_here = F.least(m, F.lit(w))
    smallest = F.transform(F.sequence(F.lit(1), m - w_here + 1), lambda i: F.array_min(F.slice(grams_col, i, w_here)))
    return F.when(m > 0, F.array_distinct(smallest)).otherwise(F.array().cast("array<bigint>"))


def hashes(picks: Column) -> Column:
    return F.transform(picks, lambda p: F.shiftright(p, 24))


def fingerprint_text(picks: Column) -> Column:
    """``hash@position`` of the chosen grams (hash in hexadecimal), comma-joined."""
    return F.array_join(F.transform(picks, lambda p: F.concat(
        F.hex(F.shiftright(p, 24)), F.lit("@"), (F.lit(_POS) - p.bitwiseAND(F.lit(_POS))).cast("string"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints' hash sets; two empty fingerprints are alike."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        both / (F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both))


def add_fingerprint(df: DataFrame, text_col: str, out: str, k: int = 5, w: int = 8) -> DataFrame:
    """``df`` with ``out``: the packed chosen grams of ``text_col`` (not NULL)."""
    df = df.withColumn("_words", words(F.col(text_col))).withColumn("_grams", chosen("_words", k, w))
    return df.withColumn(out, windows("_grams", w)).drop("_words", "_grams")


def with_next(rows: DataFrame, id_col: str, text_col: str, ranges: int) -> DataFrame:
    """``rows`` dealt by ranges of the (numeric) id, each range's first row repeated behind the range
    before it (the first range's behind the last): ``_bucket, _extra`` say where a row belongs and whether
    it is such a repetition.  A window over ``_bucket`` then sees every row's successor without ever
    sorting the table in one task.  NULL ids come first, rows of equal ids are ordered by text hash.
    """
    spark = rows.sparkSession
    points = [i / ranges for i in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx(id_col, points, 10_000).alias("b")).first()["b"] if points else None
    bounds = sorted(set(bounds or []))
    place = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(id_col))) if bounds else F.lit(0)
    place = F.when(F.col(id_col).isNull(), F.lit(0)).otherwise(place)
    dealt = rows.withColumn("_order", F.xxhash64(text_col)).withColumn("_bucket", place)
    # at most one narrow row per range comes to the driver
    first = dealt.groupBy("_bucket").agg(F.min(F.struct(F.col(id_col).isNotNull().alias("known"),
                                                        F.col(id_col).alias("id"), F.col("_order").alias("o"))).alias("f"))
    firsts = sorted((r["_bucket"], r["f"]["id"], r["f"]["o"]) for r in first.select("_bucket", "f").collect())
    if not firsts:
        return dealt.withColumn("_extra", F.lit(False))
    kind = dict(rows.dtypes)[id_col]
    to = [(firsts[i - 1][0], f[1], f[2]) for i, f in enumerate(firsts)]
    heads = spark.createDataFrame(to, f"_to int, _hid {kind}, _ho long")
    extra = dealt.join(F.broadcast(heads), F.col(id_col).eqNullSafe(F.col("_hid")) & (F.col("_order") == F.col("_ho")))
    extra = extra.withColumn("_bucket", F.col("_to")).drop("_to", "_hid", "_ho").withColumn("_extra", F.lit(True))
    return dealt.withColumn("_extra", F.lit(False)).unionByName(extra)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, w: int = 8,
                        ranges: int | None = None) -> DataFrame:
    """Per row: ``_id, n_chars, edited`` (the last half replaced by the start of the next document's
    text), ``picks, edited_picks, next_picks`` (packed fingerprints).  NULL text is empty."""
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    dealt = with_next(rows, "_id", "_text", ranges).repartition("_bucket")
    marked = add_fingerprint(dealt, "_text", "picks", k, w)
    order = Window.partitionBy("_bucket").orderBy("_extra", F.col("_id").asc_nulls_first(), "_order")
    led = marked.withColumn("_next", F.lead(F.struct("_text", "picks")).over(order)).filter(~F.col("_extra"))
    n = F.char_length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.col("_text").substr(F.lit(1), n - half), F.col("_next._text").substr(F.lit(1), half))
    led = led.select("_id", n.alias("n_chars"), edited.alias("edited"), "picks", F.col("_next.picks").alias("next_picks"))
    return add_fingerprint(led, "edited", "edited_picks", k, w)
