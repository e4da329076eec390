"""Training fields derived from token ids (pure Column expressions).

``labels`` copy the ids with the first token masked, ``position_ids`` count
from 0, ``length`` is the token count.  ``truncate_ids`` cuts to a budget;
labels and positions are recomputed from what is left, so truncation and
field derivation commute.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: label given to the first token of every conversation.
IGNORE_INDEX = -100


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def labels_for(ids: Column | str) -> Column:
    """Copy of the ids with position 0 replaced by -100."""
    ids = _col(ids)
    masked = F.concat(F.array(F.lit(IGNORE_INDEX)), F.slice(ids, F.lit(2), F.size(ids)))
    return F.when(F.size(ids) > 0, masked).otherwise(ids)


def position_ids_for(ids: Column | str) -> Column:
    """0..n-1; an empty array stays empty (``sequence(0,-1)`` would count down)."""
    ids = _col(ids)
    n = F.size(ids)
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def length_of(ids: Column | str) -> Column:
    return F.size(_col(ids)).cast("int")


def truncate_ids(ids: Column | str, max_length: int) -> Column:
    """Keep the first ``max_length`` ids (shorter rows unchanged)."""
    return F.slice(_col(ids), 1, max_length)


def with_training_fields(df, ids_col: str = "input_ids"):
    """Add ``labels``, ``position_ids`` and ``length`` next to ``ids_col``."""
    return df.select(
        "*",
        labels_for(ids_col).alias("labels"),
        position_ids_for(ids_col).alias("position_ids"),
        length_of(ids_col).alias("length"),
    )


def array_text(c: Column | str) -> Column:
    """Comma-joined text of an int array (stable form for value comparison)."""
    return F.array_join(_col(c).cast("array<string>"), ",")
