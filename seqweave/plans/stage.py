"""Materialize intermediate tables in the cluster's shared checkpoint folder.

A staged table is written as Parquet under ``spark.checkpoint.dir`` and read
back.  That cuts the lineage (a lost executor does not force a rescan of the
whole input), and later passes that need only a few columns read just those
columns.  Small plan tables go the same way so that the histogram behind them
is computed exactly once.  Tables of one application share the folder
``<checkpoint dir>/seqweave-stage/<application id>``.  Tables staged inside
``stages_removed`` go when its block ends (jobs and micro-batches use it);
others stay until that folder is removed after the application's run.

``stage_parts`` stages a wide table so that something computed from its narrow columns can be put beside
its rows without moving them: each writing task makes one bucket, rows are named by (task, place), and Spark
knows the table as partitioned by the task.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqweave.session import checkpoint_dir


def stage_root(spark) -> str:
    """Folder of this application's staged tables (one place to remove after a run)."""
    base = checkpoint_dir(spark).rstrip("/")
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect
        app = "connect"
    return f"{base}/seqweave-stage/{app}"


_TABLE = "table:"
#: paths (and names of tables) staged in the current block, innermost block last
_open: ContextVar[tuple] = ContextVar("seqweave_open_stages", default=())


@contextmanager
def stages_removed(spark):
    """Remove the tables staged in the block when it ends (``keep=True`` ones go to the block around it)."""
    paths: list[str] = []
    token = _open.set((*_open.get(), paths))
    try:
        yield
    finally:
        _open.reset(token)
        sc = spark.sparkContext
        for path in paths:
            if path.startswith(_TABLE):
                spark.sql(f"DROP TABLE IF EXISTS {path.removeprefix(_TABLE)}")
                continue
            hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hpath, True)


def stage_table(df: DataFrame, name: str, metrics: dict | None = None, keep: bool = False):
    """Write ``df`` under the checkpoint folder and read it back.

    ``metrics`` (name -> aggregate Column) are observed while the table is
    written (``DataFrame.observe``), so small facts about it, such as its row
    count, come without another job; then ``(table, values)`` is returned.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    blocks = _open.get()[:-1] if keep else _open.get()
    if blocks:
        blocks[-1].append(path)
    observation = None
    if metrics:
        from pyspark.sql import Observation

        observation = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        df = df.observe(observation, *[c.alias(k) for k, c in metrics.items()])
    df.write.mode("overwrite").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if observation is None:
        return table
    return table, dict(observation.get)


def _task_labels(spark, n: int) -> DataFrame:
    """``_b, _part``: for each bucket a number that Spark's bucketing puts into it (one row per writing task)."""
    tries = spark.range(24 * n + 64).select(F.pmod(F.hash("id"), F.lit(n)).alias("_b"), F.col("id"))
    return tries.groupBy("_b").agg(F.min("id").alias("_part"))


def _bucketed(df: DataFrame, name: str, n: int, keys: list[str]) -> DataFrame:
    """Write ``df``, whose tasks hold one bucket each, as a bucketed table."""
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    table = f"seqweave_{uuid.uuid4().hex}"
    if _open.get():
        _open.get()[-1].extend([_TABLE + table, path])
    # one bucket a task: no sort by bucket is needed
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "4")
    try:
        df.write.mode("overwrite").format("parquet").bucketBy(n, *keys).option("path", path).saveAsTable(table)
    finally:
        spark.conf.set(setting, before)
    return spark.table(table)


def stage_buckets(df: DataFrame, name: str, keys: list[str], n: int) -> DataFrame:
    """Stage ``df`` dealt into ``n`` buckets by ``keys``: it is shuffled once, and groupings, cogroupings and joins on
    ``keys`` read it without another shuffle."""
    n = _bucket_count(df.sparkSession, n)
    return _bucketed(df.repartition(n, *keys), name, n, keys)


def _bucket_count(spark, wanted: int) -> int:
    """At least a shuffle's partitions (so that a join keeps the buckets), at most what Spark allows."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(max(int(wanted), least), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))


def stage_parts(df: DataFrame, name: str, parts: int = 0) -> DataFrame:
    """Stage ``df`` in one bucket per writing task, with ``_part`` (names the task) and ``_pos`` (place in it, from 0).

    ``parts`` is the number of tasks that write, as far as the caller knows it; with more tasks than that, some
    share a bucket.  Joins and groupings on ``_part`` leave the rows where they are.
    """
    spark = df.sparkSession
    n = _bucket_count(spark, parts)
    numbered = df.withColumn("_m", F.monotonically_increasing_id()).withColumn(
        "_b", F.pmod(F.shiftright("_m", 33), F.lit(n)).cast("int"))
    named = numbered.join(F.broadcast(_task_labels(spark, n)), "_b", "left").select(
        *df.columns, F.coalesce("_part", F.col("_b").cast("long")).alias("_part"),
        F.struct(F.shiftright("_m", 33).alias("task"), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)).alias("row")).alias("_pos"))
    return _bucketed(named, name, n, ["_part"])


def beside_parts(staged: DataFrame, narrow: DataFrame, cols: list[str]) -> DataFrame:
    """``staged`` (from ``stage_parts``) with ``cols`` of ``narrow``, which has one row per ``_part, _pos`` of it.

    Only ``narrow`` is shuffled, as one list per writing task, so the list is bounded by one task's rows; a row
    finds its entry by its place.
    """
    entry = F.struct("_pos", *cols)
    lists = narrow.groupBy("_part").agg(F.array_sort(F.collect_list(entry)).alias("_list"))
    tasks = F.array_distinct(F.transform("_list", lambda e: e["_pos"]["task"]))
    lists = lists.select("_part", "_list", F.transform(tasks, lambda t: F.struct(
        t.alias("task"), F.array_position(F.transform("_list", lambda e: e["_pos"]["task"]), t).alias("first"))).alias("_tasks"))
    both = staged.join(lists.hint("shuffle_hash"), "_part")
    task = F.filter("_tasks", lambda t: t["task"] == F.col("_pos.task"))[0]["first"]  # nearly always one task a part
    found = F.element_at("_list", (task + F.col("_pos.row")).cast("int"))
    return both.select(*staged.columns, found.alias("_found")).select(
        *staged.columns, *[F.col(f"_found.{c}").alias(c) for c in cols]).drop("_part", "_pos")
