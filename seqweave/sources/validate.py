"""Strict checks on assembled conversations (any source).

The reference decodes every message into a typed (role, content) pair and
stops on the first failure; an empty conversation cannot be rendered either.
``check_messages`` applies the same rule to a ``messages`` column built by
any source (the JSONL reader checks JSON types before this point).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqweave.sources.jsonl import MESSAGES_TYPE


def message_error(messages: Column | str = "messages") -> Column:
    """NULL when valid, else the reason."""
    m = F.col(messages) if isinstance(messages, str) else messages
    complete = F.forall(m, lambda x: x["role"].isNotNull() & x["content"].isNotNull())
    return (
        F.when(m.isNull(), F.lit("missing conversation"))
        .when(F.size(m) == 0, F.lit("empty conversation"))
        .when(~complete, F.lit("message without string role and content"))
    )


def check_messages(df: DataFrame, key_col: str, on_error: str = "fail"):
    """``fail``: the job raises on the first bad row; ``quarantine``: returns
    ``(good, bad)`` with the reason in ``bad.error``."""
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    err = message_error("messages")
    if on_error == "fail":
        checked = F.when(err.isNotNull(), F.raise_error(F.concat(
            F.lit("invalid conversation "), F.col(key_col).cast("string"), F.lit(": "), err))
        ).otherwise(F.col("messages")).cast(MESSAGES_TYPE)
        return df.withColumn("messages", checked)
    with_err = df.withColumn("error", err)
    return (with_err.filter(F.col("error").isNull()).drop("error"),
            with_err.filter(F.col("error").isNotNull()))
