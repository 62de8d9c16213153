"""Interactions -> graded ratings.

Plan shape: one partial + final hash aggregate of hours per item (a hot item
is pre-aggregated on the map side, so it costs one partial row per task),
then the average joined back onto every interaction by item key, then the
native rating CASE, cast and null drop, all inside one codegen stage.

The join side is the per-item average. When a workspace is given, that
table is materialized first and counted: it is broadcast only if its exact
row count fits the broadcast budget; beyond that the join is a shuffle
merge join whose hot-key partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.functions.rating import rating_expr
from sparkrec.plans.joins import bounded_side

# Width of a materialized average row for the broadcast check: int key + double.
AVG_ROW_BYTES = 48


def item_average(
    interactions: DataFrame, item: str = "item_id", hours: str = "hours", out: str = "avg_hours"
) -> DataFrame:
    """``(item, avg_hours double)``: mean hours per item; nulls skipped, NaN propagates."""
    return interactions.groupBy(item).agg(F.avg(hours).alias(out))


def with_item_average(
    interactions: DataFrame,
    averages: DataFrame,
    item: str = "item_id",
    averages_rows: int | None = None,
) -> DataFrame:
    """Inner join of the averages back onto the interactions (``USING`` item).

    ``averages_rows`` is the proven row count of ``averages`` (when known);
    with it the side is broadcast or shuffle-joined per :mod:`plans.joins`.
    Rows with a null item key have no average and drop out.
    """
    side = averages if averages_rows is None else bounded_side(averages, averages_rows, AVG_ROW_BYTES)
    return interactions.join(side, item)


def rate(
    joined: DataFrame,
    user: str = "user_id",
    item: str = "item_id",
    out: str = "rating",
    is_recommended: str = "is_recommended",
    hours: str = "hours",
    avg_hours: str = "avg_hours",
    keep_nulls: bool = False,
) -> DataFrame:
    """``(user, item, rating float)`` from interactions joined with averages."""
    rated = joined.select(
        F.col(user),
        F.col(item),
        rating_expr(is_recommended, hours, avg_hours).cast("float").alias(out),
    )
    return rated if keep_nulls else rated.dropna(subset=[out])


def derive_ratings(
    interactions: DataFrame,
    workspace=None,
    user: str = "user_id",
    item: str = "item_id",
    out: str = "rating",
    is_recommended: str = "is_recommended",
    hours: str = "hours",
    spread: bool = True,
) -> DataFrame:
    """Interactions -> ratings 1-4; rows whose rule gives no rating are dropped.

    Rows with a null user key are dropped too (they cannot be factorized).

    With a ``workspace`` the input is needed twice (averages, then the rows
    they are joined onto), so its four columns are written there once: an
    expensive source (a join, a CSV parse) runs a single time, and both
    passes become narrow Parquet scans (two and four columns). The rows are
    spread over ``spark.sql.shuffle.partitions`` files, unless ``spread`` is
    false, as for rows that a shuffle has just dealt to tasks. The per-item
    averages are materialized and counted as well, which fixes the size
    check of the join on exact numbers.
    """
    pruned = interactions.select(user, item, is_recommended, hours)
    rows = None
    if workspace is not None:
        partitions = int(interactions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pruned = workspace.materialize(pruned, "interactions", partitions=partitions if spread else None)
    averages = item_average(pruned, item, hours)
    if workspace is not None:
        averages = workspace.materialize(averages, "item_average")
        rows = averages.count()
    joined = with_item_average(pruned, averages, item, rows)
    rated = rate(joined, user, item, out, is_recommended, hours)
    return rated.filter(F.col(user).isNotNull())
