"""Error expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_error(actual: str = "rating", predicted: str = "prediction") -> Column:
    diff = F.col(actual).cast("double") - F.col(predicted).cast("double")
    return diff * diff


def rmse_agg(actual: str = "rating", predicted: str = "prediction") -> Column:
    """Root of the mean squared difference; partial-aggregated like any avg."""
    return F.sqrt(F.avg(squared_error(actual, predicted)))
