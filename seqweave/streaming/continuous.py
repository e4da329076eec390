"""Continuous packing: new JSONL files in a folder are packed as they arrive.

A Structured Streaming file source lists the folder (``*.jsonl``, not
recursive) and hands whole files to each micro-batch, so packing a batch per
input file gives exactly the bins the batch job gives for those files.  Each
micro-batch runs the same DataFrame job as ``pack_job`` through
``foreachBatch``; no watermark or streaming state is needed because bins
never span files.  Output of a batch goes to ``<out>/batch=<k>/`` with
overwrite semantics (Arrow parts are named per batch), so a replayed batch
rewrites the same files instead of duplicating them.

Spark's checkpoint knows which files it has handed out, but not after the checkpoint is lost or replaced.  The ledger
``<out>/_ledger`` (one small Parquet table per batch: file, size, modification time, query, batch) outlives it:

* a file that another query's batch has packed unchanged is left out;
* a file that has changed since it was packed stops the query (``on_rewrite="fail"``) or is packed again, its
  earlier output being dropped (``"repack"``);
* a query with a new checkpoint numbers its folders behind those of earlier ones.
"""

from __future__ import annotations


import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqweave.functions.template import ChatTemplate
from seqweave.plans.job import pack_lines
from seqweave.plans.stage import stage_table, stages_removed
from seqweave.sinks.arrow_stream import qualified
from seqweave.sinks.publish import Folder
from seqweave.sources.jsonl import file_stem, listing, without_cr

LEDGER = "_ledger"
_LEDGER_SCHEMA = "source_file string, file_stem string, size long, modified timestamp, query string, batch long, folder long"


def stream_lines(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("pathGlobFilter", "*.jsonl")
    # the default forgets files older than a week and would never pack them
    reader = reader.option("maxFileAge", "36500d").option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if re.search(r"[\[\]{}*?\\]", input_dir):
        raise ValueError(f"Spark's file stream reads the folder's name as a pattern, rename it: {input_dir}")
    raw = reader.load(input_dir)
    return raw.select(
        F.col("_metadata.file_path").alias("source_file"),
        file_stem(F.col("_metadata.file_name")).alias("file_stem"),
        without_cr("value").alias("line"),
        F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified"),
    )


class Ledger:
    """What the batches of all queries that ever wrote to ``out`` have packed."""

    def __init__(self, spark: SparkSession, out: str, on_rewrite: str):
        if on_rewrite not in ("fail", "repack"):
            raise ValueError("on_rewrite must be 'fail' or 'repack'")
        self.spark, self.out, self.on_rewrite = spark, qualified(spark, out), on_rewrite

    def read(self) -> DataFrame:
        if not Folder(self.spark, self.out).exists(LEDGER):
            return self.spark.createDataFrame([], _LEDGER_SCHEMA)
        return self.spark.read.schema(_LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.out}/{LEDGER}")

    def folder_of(self, query: str, batch: int) -> int:
        others = self.read().filter(F.col("query") != query).agg(F.max("folder").alias("k")).first()["k"]
        return batch + (0 if others is None else others + 1)

    def fresh(self, files: DataFrame, query: str) -> tuple[DataFrame, DataFrame]:
        """(files to pack, earlier entries that they replace) of a batch's files."""
        packed = self.read().filter(F.col("query") != query)
        latest = packed.groupBy("source_file").agg(F.max_by(F.struct("size", "modified", "folder"), "folder").alias("_old"))
        both = files.join(latest, "source_file", "left")
        same = F.col("_old").isNotNull() & (F.col("_old.size") == F.col("size")) & (F.col("_old.modified") == F.col("modified"))
        changed = both.filter(F.col("_old").isNotNull() & ~same)
        if self.on_rewrite == "fail":
            one = changed.select("source_file").first()
            if one is not None:
                raise ValueError(f"{one[0]} has changed since it was packed; use on_rewrite='repack' to pack it again")
        return both.filter(~same).select(*files.columns), changed.select("file_stem", F.col("_old.folder").alias("folder"))

    def note(self, files: DataFrame, query: str, batch: int, folder: int) -> None:
        rows = files.select("source_file", "file_stem", "size", "modified", F.lit(query).alias("query"),
                            F.lit(batch).cast("long").alias("batch"), F.lit(folder).cast("long").alias("folder"))
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.out}/{LEDGER}/batch-{folder}")

    def drop(self, replaced: list, fmt: str) -> None:
        """Remove the earlier output of files that were packed again."""
        at = Folder(self.spark, self.out)
        for row in replaced:
            base, stem = f"batch={row['folder']}", row["file_stem"]
            for name in (f"{base}/{stem}", f"{base}/file_stem={stem}", f"{base}/{stem}.{fmt}", f"{base}/_index/{stem}",
                         f"{base}/_index/{stem}.{fmt}.index"):
                at.delete(name)


def start_continuous_pack(spark: SparkSession, input_dir: str, output_path: str,
                          template: ChatTemplate | None = None, tokenizer=None,
                          max_length: int = 8192, fmt: str = "arrow", tail: str = "keep",
                          on_error: str = "fail", checkpoint_location: str | None = None,
                          max_files_per_trigger: int | None = None, available_now: bool = False,
                          processing_time: str | None = None, on_rewrite: str = "fail"):
    """Start the streaming query; returns the ``StreamingQuery``."""
    out = output_path.rstrip("/")
    # beside the output, so a restarted application finds it again
    location = checkpoint_location or f"{out}/_checkpoint"
    Ledger(spark, out, on_rewrite)  # checks the option
    listing(spark, input_dir)  # names that the source would skip are refused

    def pack_batch(batch: DataFrame, batch_id: int) -> None:
        listing(spark, input_dir)
        # a micro-batch has a session of its own, which must stay the active one
        ledger = Ledger(batch.sparkSession, out, on_rewrite)
        query = Folder(spark, qualified(spark, location)).read("metadata")["id"]
        folder = ledger.folder_of(query, batch_id)
        with stages_removed(spark):  # nothing of a batch stays in the staging folder
            files = batch.select("source_file", "file_stem", "size", "modified").distinct()
            fresh, replaced = ledger.fresh(stage_table(files, "batch-files"), query)
            fresh = stage_table(fresh, "fresh-files")  # the ledger changes below
            lines = batch.join(fresh.select("source_file"), "source_file", "left_semi")
            gone = replaced.collect() if on_rewrite == "repack" else []
            pack_lines(lines.select("source_file", "file_stem", "line"), f"{out}/batch={folder}", template, tokenizer,
                       max_length, fmt, tail, on_error, part_prefix=f"b{folder}-")
            ledger.note(fresh, query, batch_id, folder)
            ledger.drop(gone, fmt.lower())

    writer = stream_lines(spark, input_dir, max_files_per_trigger).writeStream.foreachBatch(pack_batch)
    writer = writer.option("checkpointLocation", location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
