"""Join strategy behind a proven size bound.

A side is broadcast only when its exact row count, taken from a
materialized (or otherwise cheap to count) DataFrame, times a fixed row
width fits the session's broadcast budget. Otherwise the join stays a
shuffle join; AQE then splits partitions of a hot key on the large side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Hashed-relation bytes per row assumed for a broadcast side: UnsafeRow of
# a few fixed-width fields plus hash-map overhead; generous on purpose.
BROADCAST_ROW_BYTES = 64
DEFAULT_BUDGET_BYTES = 10 * 1024 * 1024


def _parse_bytes(text: str) -> int:
    text = text.strip().lower()
    units = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    for suffix in ("kb", "mb", "gb", "tb", "k", "m", "g", "t", "b"):
        if text.endswith(suffix):
            return int(float(text[: -len(suffix)]) * units[suffix[0]])
    return int(text)


def broadcast_budget(spark: SparkSession) -> int:
    """Byte budget for an explicit broadcast, from the session settings.

    The adaptive threshold when it is set, else the static one; a value of
    -1 (or 0) disables broadcasting, explicit ones included.
    """
    for key in ("spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"):
        try:
            value = spark.conf.get(key, None)
        except Exception:  # noqa: BLE001 - unset optional key
            value = None
        if value is not None and str(value).strip():
            return max(_parse_bytes(str(value)), 0)
    return DEFAULT_BUDGET_BYTES


def fits_broadcast(spark: SparkSession, rows: int, row_bytes: int = BROADCAST_ROW_BYTES) -> bool:
    budget = broadcast_budget(spark)
    return budget > 0 and rows * row_bytes <= budget


def bounded_side(df: DataFrame, rows: int | None = None, row_bytes: int = BROADCAST_ROW_BYTES) -> DataFrame:
    """``broadcast(df)`` if its row count is within budget, else a merge-join hint.

    ``rows`` is the proven row count when the caller already knows it (a
    limit, a counted table); otherwise ``df`` is counted, so pass only a
    materialized or metadata-countable DataFrame.
    """
    n = df.count() if rows is None else rows
    if fits_broadcast(df.sparkSession, n, row_bytes):
        return F.broadcast(df)
    return df.hint("shuffle_merge")
