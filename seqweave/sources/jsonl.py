"""JSONL conversation files: listing, strict parsing, provenance.

* A file path is read whatever its extension; a folder contributes only its
  direct children named ``*.jsonl`` (case-sensitive, not recursive).
* Each line is parsed as a variant (``try_parse_json``) so the check is as
  strict as a typed decoder: the list must sit under ``conversation`` or its
  alias ``conversations`` (not both), be non-empty, and every message must
  have string ``role`` and ``content``.  Other keys are ignored.  Spark's own
  JSON reader would turn ``"content": 5`` into ``"5"`` and a missing key into
  NULL, hence the variant route.  Long lines and lines with repeated keys go to a
  typed decoder (``sources.decode``).
* Provenance comes from the ``_metadata`` column: ``source_file`` (full path)
  and ``file_stem`` (file name without its last extension) name the output.
* ``row_key`` is a positional id, unique per line; ``pack_job`` stages the
  parsed rows so the id is fixed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqweave.plans.stage import stage_table
from seqweave.session import ship_package
from seqweave.sources.decode import LISTS, LONG_LINE, MAX_LINE, decoded

SENTINEL = "end of line 5f0c1b"
MESSAGES_TYPE = "array<struct<role:string,content:string>>"


def _folder(spark: SparkSession, path: str):
    """(file system, path) as Spark resolves it (default file system included)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def listing(spark: SparkSession, path: str) -> int | None:
    """Number of entries ``*.jsonl`` of a folder, or None for a file; names stay in the JVM.

    A missing path raises ``FileNotFoundError``; a name that starts with ``_``
    or ``.``, which Spark's readers skip, raises ``ValueError``.
    """
    fs, hpath = _folder(spark, path)
    if not fs.exists(hpath):
        raise FileNotFoundError(path)
    if fs.getFileStatus(hpath).isFile():
        return None
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobFilter
    hidden = [f.getPath().getName() for f in fs.listStatus(hpath, glob("[_.]*.jsonl")) if f.isFile()]
    if hidden:
        raise ValueError(f"files that Spark does not read, rename them: {', '.join(sorted(hidden))}")
    return len(fs.listStatus(hpath, glob("*.jsonl")))


def file_stem(name: Column) -> Column:
    """File name (as ``_metadata`` gives it, percent-encoded) without its last extension; a leading dot
    is not a separator."""
    plain = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, r"(?<=.)\.[^.]*$", "")


def without_cr(column: str) -> Column:
    """The line without a CR at its end; other lines are not copied."""
    value = F.col(column)
    return F.when(F.endswith(value, F.lit("\r")), value.substr(F.lit(1), F.char_length(value) - 1)).otherwise(value)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with provenance: ``source_file, file_stem, line_no_key, line``."""
    found = listing(spark, path)
    if found == 0:
        return spark.createDataFrame([], "source_file string, file_stem string, line string")
    # lines end at LF (a CR before it is dropped); brackets and stars in a path are ordinary characters
    reader = spark.read.format("text").option("lineSep", "\n").option("__globPaths__", "false")
    if found:
        reader = reader.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", "false")
    raw = reader.load(path)
    return raw.select(
        F.col("_metadata.file_path").alias("source_file"),
        file_stem(F.col("_metadata.file_name")).alias("file_stem"),
        without_cr("value").alias("line"),
    )


def folder_stems(spark: SparkSession, path: str) -> DataFrame:
    """``file_stem`` of every input file, those without lines included: a table that a task lists, not the driver."""
    from seqweave.sinks.arrow_stream import can_open, file_system, qualified

    where = qualified(spark, path)
    if listing(spark, path) is None:
        names = spark.range(1).select(F.lit(path.rstrip("/").rsplit("/", 1)[-1]).alias("name"))
    elif not can_open(where):  # a store that only Spark reaches
        fs, hpath = _folder(spark, path)
        here = [f.getPath().getName() for f in fs.listStatus(hpath) if f.isFile()]
        names = spark.createDataFrame([(n,) for n in here if n.endswith(".jsonl")], "name string")
    else:
        ship_package(spark)

        def names_of(batches):
            import pyarrow as pa
            import pyarrow.fs as pafs

            fs, inside = file_system(where)
            for batch in batches:
                if not batch.num_rows:
                    continue
                found = [i.base_name for i in fs.get_file_info(pafs.FileSelector(inside))
                         if i.type == pafs.FileType.File and i.base_name.endswith(".jsonl")]
                for at in range(0, len(found), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(found[at:at + 10_000], pa.string())], names=["name"])

        names = spark.range(1).mapInArrow(names_of, "name string")
    return names.select(F.regexp_replace("name", r"(?<=.)\.[^.]*$", "").alias("file_stem"))


def _string(field: Column) -> Column:
    return F.coalesce(F.schema_of_variant(field) == "STRING", F.lit(False))


def parse_conversations(lines: DataFrame) -> DataFrame:
    """Add ``messages`` and ``error`` (NULL when the line is valid; ``line`` is NULL for a good line that the decoder read).

    A line is parsed once into a variant and its list extracted once.  Lines above ``LONG_LINE`` bytes and lines the
    variant parser refuses (bad JSON, or a good line in which an ignored key occurs twice) or reads loosely (surrogate
    escapes) are judged by the typed decoder (``sources.decode``); the others never leave the JVM.
    """
    ship_package(lines.sparkSession)
    size = F.octet_length("line")
    blank = F.when(size <= LONG_LINE, F.length(F.trim(F.col("line"))) == 0).otherwise(F.lit(False))  # (no copy of a long line)
    # a line is one document: behind it, inside a list, only the sentinel may follow
    wrapped = F.concat(F.lit("["), F.col("line"), F.lit(f',"{SENTINEL}"]'))
    # the parser reads half of a surrogate pair, written as an escape, as a question mark
    halves = F.contains("line", F.lit("\\ud")) | F.contains("line", F.lit("\\uD"))
    parsed = lines.withColumn("_v", F.when((size <= LONG_LINE) & ~halves, F.try_parse_json(wrapped)))
    whole = (F.try_variant_get("_v", "$[1]", "string") == SENTINEL) & F.try_variant_get("_v", "$[2]", "variant").isNull()
    parsed = parsed.withColumn("_v", F.when(F.coalesce(whole, F.lit(False)), F.col("_v")))

    def under(key: str, kind: str) -> Column:
        return F.try_variant_get("_v", f"$[0].{key}", kind)

    typed = F.coalesce(*[under(k, "array<struct<role:variant,content:variant>>") for k in LISTS])
    keep = [c for c in lines.columns if c != "line"]
    again = ~blank & F.col("_v").isNull() & (size <= MAX_LINE)
    # a line that goes to the decoder is carried once
    parsed = parsed.select(*keep, "_v", typed.alias("_typed"), blank.alias("_blank"), size.alias("_size"),
                           F.when(again, F.col("line")).alias("_long"), F.when(~again, F.col("line")).alias("_short"))
    parsed = parsed.withColumn("_again", decoded(F.col("_long"))).drop("_long")
    good = F.forall("_typed", lambda m: F.coalesce(_string(m["role"]) & _string(m["content"]), F.lit(False)))
    one, many = [under(k, "variant").isNotNull() for k in LISTS]
    lists = F.coalesce(*[under(k, "array<variant>") for k in LISTS])
    error = (
        F.when(F.col("_blank"), F.lit("blank line"))
        .when(F.col("_size") > MAX_LINE, F.concat(F.lit("line of "), F.col("_size"), F.lit(f" bytes, the limit is {MAX_LINE}")))
        .when(F.col("_v").isNull(), F.col("_again.error"))
        .when(one & many, F.lit("both conversation and conversations"))
        .when(F.size("_typed") == 0, F.lit("empty conversation"))
        .when(F.col("_typed").isNotNull() & good, F.lit(None))
        .when(~(one | many), F.lit("missing conversation"))
        .when(lists.isNull(), F.lit("conversation is not a list"))
        .otherwise(F.lit("message without string role and content"))
    )
    parsed = parsed.withColumn("error", error)
    line = F.coalesce("_short", "_again.line")
    messages = F.transform("_typed", lambda m: F.struct(
        F.variant_get(m["role"], "$", "string").alias("role"), F.variant_get(m["content"], "$", "string").alias("content")))
    return parsed.select(*keep, line.alias("line"), F.when(F.col("error").isNull(), F.coalesce("_again.messages", messages)).cast(
        MESSAGES_TYPE).alias("messages"), "error")


def conversations_from_lines(lines: DataFrame, on_error: str = "fail"):
    """Parsed conversations from ``source_file, file_stem, line`` rows.

    Returns ``source_file, file_stem, row_key, messages``.  ``on_error="fail"``
    makes the job fail on the first bad line (the reference stops too);
    ``"quarantine"`` returns ``(good, bad)`` where ``bad`` keeps the line and
    the reason.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    rows = parse_conversations(lines).withColumn("row_key", F.monotonically_increasing_id())
    if on_error == "quarantine":
        # read and parsed once for both results; only bad lines are kept as text
        rows = rows.withColumn("line", F.when(F.col("error").isNotNull(), F.col("line")))
        rows = stage_table(rows, "parsed")
    cols = ["source_file", "file_stem", "row_key", "messages"]
    if on_error == "fail":
        checked = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(
            F.lit("invalid conversation in "), F.col("source_file"), F.lit(": "), F.col("error")))
        ).otherwise(F.col("messages")).cast(MESSAGES_TYPE)
        return rows.select("source_file", "file_stem", "row_key", checked.alias("messages"))
    good = rows.filter(F.col("error").isNull()).select(*cols)
    bad = rows.filter(F.col("error").isNotNull()).select("source_file", "file_stem", "row_key", "line", "error")
    return good, bad


def read_conversations(spark: SparkSession, path: str, on_error: str = "fail"):
    """Conversations from a JSONL file or folder (see ``conversations_from_lines``)."""
    return conversations_from_lines(read_lines(spark, path), on_error)


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines per input file (the reference prints this per file)."""
    return read_lines(spark, path).groupBy("source_file", "file_stem").agg(
        F.count(F.lit(1)).alias("n_lines"))
