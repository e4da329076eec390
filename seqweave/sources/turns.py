"""Conversations assembled from a turns table (one row per message)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqweave.sources.validate import check_messages


# Fixed value: schema of a turns table (one row per message).
TURNS_SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """A Parquet table; with a known ``schema`` no inference job is run."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def conversations_from_turns(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                             role: str = "role", text: str = "text",
                             source_file: Column | None = None, on_error: str = "fail"):
    """Group turns into ``messages: array<struct<role, content>>`` per conversation.

    One hash aggregation on the conversation key; the messages are ordered by
    ``order`` with ``array_sort`` (a conversation is one input record, like a
    JSONL line, so the group is bounded by one conversation).  The result stays
    hash-partitioned by ``key``, which later per-conversation regroupings reuse.
    ``source_file`` optionally tags each conversation with the file it belongs to.
    Messages with a NULL role or text fail the job (``on_error="fail"``) or,
    with ``"quarantine"``, are returned apart as ``(good, bad)``.
    """
    member = F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.col(text).alias("content"))
    grouped = turns.groupBy(key).agg(F.array_sort(F.collect_list(member)).alias("_m"))
    messages = F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    cols = [F.col(key), messages.alias("messages")]
    if source_file is not None:
        cols.insert(1, source_file.alias("source_file"))
    return check_messages(grouped.select(*cols), key, on_error)


def shard_of(key: str = "conv_id", shards: int = 4) -> Column:
    """Deterministic file tag ``shard-<k>`` used to emulate several input files."""
    return F.concat(F.lit("shard-"), F.pmod(F.col(key), F.lit(shards)).cast("string"))


def single_file(name: str = "conversations") -> Column:
    return F.lit(name)
