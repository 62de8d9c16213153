"""The graded-rating rule as one native CASE expression (no Python UDF).

Rule, comparing a review's hours with its item's average hours:

=================  =====================  ======
recommended        hours vs. average      rating
=================  =====================  ======
yes                hours >= average       4
yes                hours <  average       3
no / unknown       hours >  average       2
no / unknown       hours <  average       1
no / unknown       hours == average       null
=================  =====================  ======

A null flag counts as "no". NaN or null hours / average give null, as every
comparison with NaN is false in the original rule (Spark orders NaN above
all numbers, hence the explicit guard). Null ratings are dropped later.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rating_expr(
    is_recommended: str | Column = "is_recommended",
    hours: str | Column = "hours",
    avg_hours: str | Column = "avg_hours",
) -> Column:
    """Integer rating 1-4, or null, per the table above."""
    rec, h, avg = _col(is_recommended), _col(hours), _col(avg_hours)
    comparable = h.isNotNull() & avg.isNotNull() & ~F.isnan(h) & ~F.isnan(avg)
    recommended = F.coalesce(rec, F.lit(False))
    return (
        F.when(~comparable, F.lit(None).cast("int"))
        .when(recommended, F.when(h >= avg, F.lit(4)).otherwise(F.lit(3)))
        .when(h > avg, F.lit(2))
        .when(h < avg, F.lit(1))
    )


def rating_sql(is_recommended: str = "is_recommended", hours: str = "hours", avg_hours: str = "avg_hours") -> str:
    """The same rule as portable SQL text (used by oracles and ``spark.sql``)."""
    return (
        f"CASE WHEN {hours} IS NULL OR {avg_hours} IS NULL OR isnan({hours}) OR isnan({avg_hours}) THEN NULL "
        f"WHEN coalesce({is_recommended}, false) THEN CASE WHEN {hours} >= {avg_hours} THEN 4 ELSE 3 END "
        f"WHEN {hours} > {avg_hours} THEN 2 "
        f"WHEN {hours} < {avg_hours} THEN 1 END"
    )
