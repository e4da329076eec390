"""Sinks for packed bins and the format dispatch.

* ``parquet``: Spark's writer, ``partitionBy(file_stem)``; the column ``bin`` keeps the creation order.
* ``jsonl``: one bin per line, keys in the order ``input_ids, labels,
  position_ids, length``; lines serialized by ``to_json`` in the JVM and
  written per input file by the bin-files data source (``sinks.arrow_stream``),
  so names follow the input: ``<stem>.jsonl`` or ``<stem>/part-<k>.jsonl``.
* ``arrow``: Arrow IPC streams by the same data source.

Rows are clustered by ``(file_stem, bin bucket)`` so that many tasks can
write one large input file's bins in parallel, and sorted by bin inside each
task so every output part lists bins in creation order (over-long rows
first, as the reference writes them).  Whatever the format, a job's output
replaces the earlier one as one step (``sinks.publish``).  ``layout="file"`` instead puts every
stem in one task and file, matching the reference's file naming.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqweave.session import ship_package
from seqweave.sinks.arrow_stream import BinFilesDataSource, qualified
from seqweave.sinks.publish import publish_files, publish_partitions, recover, temporary

JSONL_COLUMNS = ["input_ids", "labels", "position_ids", "length"]
BINS_PER_PART = 8192
TOKENS_PER_PART = 1 << 26
# "file" layout: every bin of an input file in one writer task
ONE_PART = 1 << 62


def bins_per_part_for(max_length: int) -> int:
    """Bins of one output part: at most 8192, and at most about 64M tokens whatever the bin size."""
    return max(1, min(BINS_PER_PART, TOKENS_PER_PART // int(max_length)))


def _register(spark) -> None:
    """Each session, a micro-batch's too, knows its own data sources only."""
    ship_package(spark)
    spark.dataSource.register(BinFilesDataSource)


def _cluster(bins: DataFrame, layout: str, bins_per_part: int) -> DataFrame:
    if layout == "file":
        return bins.repartition("file_stem").sortWithinPartitions("file_stem", "bin")
    bucket = F.expr(f"bin div {int(bins_per_part)}")  # the writer names parts by this bucket
    return bins.repartition("file_stem", bucket).sortWithinPartitions("file_stem", "bin")


def write_bins(bins: DataFrame, output_path: str, fmt: str = "arrow", layout: str = "parts",
               bins_per_part: int = BINS_PER_PART, part_prefix: str = "",
               clustered: bool = False, empty: DataFrame | None = None) -> None:
    """Write packed bins (must carry ``file_stem`` and ``bin``).

    The earlier output of the same input files in the same format is
    replaced; other files and formats in the folder stay.  ``empty`` lists
    input files without bins (``file_stem``): Arrow and JSONL get an empty
    file for each, Parquet loses the folder an earlier run may have left.

    ``clustered=True`` says the bins are already partitioned for writing
    (``materialize_bins(bins_per_part=...)``), so only a local sort by bin
    happens here.  ``part_prefix`` makes Arrow part names unique per writer
    run (streaming micro-batches); a re-run of the same batch rewrites the
    same names.
    """
    fmt = fmt.lower()
    if layout not in ("parts", "file"):
        raise ValueError("layout must be 'parts' or 'file'")
    if clustered:
        ready = bins.sortWithinPartitions("file_stem", "bin")
    else:
        ready = _cluster(bins, layout, bins_per_part)
    spark, job = bins.sparkSession, uuid.uuid4().hex
    path = qualified(spark, output_path)
    recover(spark, path)
    if fmt == "parquet":
        (ready.select("file_stem", "bin", *JSONL_COLUMNS).write.partitionBy("file_stem")
         .parquet(f"{path.rstrip('/')}/{temporary(job)}"))
        publish_partitions(spark, path, job, [] if empty is None else _partitions(empty))
    elif fmt in ("jsonl", "arrow"):
        if fmt == "jsonl":
            line = F.to_json(F.struct(*JSONL_COLUMNS))
            payload = ready.select("file_stem", "bin", line.alias("line"))
        else:
            payload = ready.select("file_stem", "bin", "input_ids", "labels", "position_ids")
        if empty is not None:
            payload = payload.unionByName(empty.select("file_stem"), allowMissingColumns=True)
        _save(payload, path, job, fmt, layout=layout, prefix=part_prefix, bins_per_part=str(bins_per_part))
    else:
        raise ValueError(f"format not supported: {fmt}")


def _save(payload: DataFrame, path: str, job: str, fmt: str, **options) -> None:
    _register(payload.sparkSession)
    (payload.write.format(BinFilesDataSource.name()).mode("append").option("path", path).option("format", fmt)
     .option("job_id", job).options(**options).save())
    publish_files(payload.sparkSession, path, job, True, fmt)


def _partitions(stems: DataFrame) -> list[str]:
    """The ``file_stem=`` folders of input files that now have no bins."""
    catalog = stems.sparkSession.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return [f"file_stem={catalog.escapePathName(row[0])}" for row in stems.select("file_stem").toLocalIterator()]


def write_lines(df: DataFrame, output_path: str, stem_col: str = "file_stem", line_col: str = "line",
                order_col: str | None = None) -> None:
    """Write text lines as one ``<stem>.jsonl`` file per stem (overwrites those files).

    Rows are clustered by stem (one writer task per file, like the
    reference's one file per input) and sorted by ``order_col`` if given.
    """
    order = F.col(order_col) if order_col else F.lit(0)
    payload = df.select(F.col(stem_col).alias("file_stem"), order.cast("long").alias("bin"),
                        F.col(line_col).alias("line"))
    payload = payload.repartition("file_stem").sortWithinPartitions("file_stem", "bin")
    path = qualified(df.sparkSession, output_path)
    recover(df.sparkSession, path)
    _save(payload, path, uuid.uuid4().hex, "jsonl", layout="file", index="false")
