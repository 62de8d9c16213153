"""The rating rule on the edge rows of FIXTURES.md §3, in Spark and DuckDB."""

import math

import duckdb
import pytest
from pyspark.sql.types import BooleanType, DoubleType, FloatType, StructField, StructType

from sparkrec.functions.rating import rating_expr, rating_sql

NAN = float("nan")

# (is_recommended, hours, avg_hours, expected rating)
EDGE_ROWS = [
    (True, 5.0, 3.0, 4),
    (True, 3.0, 3.0, 4),
    (True, 1.0, 3.0, 3),
    (False, 5.0, 3.0, 2),
    (False, 3.0, 3.0, None),
    (False, 1.0, 3.0, 1),
    (None, 5.0, 3.0, 2),
    (None, 3.0, 3.0, None),
    (None, 1.0, 3.0, 1),
    (True, NAN, 3.0, None),
    (False, NAN, 3.0, None),
    (None, NAN, 3.0, None),
    (True, 1.0, NAN, None),
    (False, 1.0, NAN, None),
    (None, 1.0, NAN, None),
    (True, NAN, NAN, None),
    (False, NAN, NAN, None),
    (None, NAN, NAN, None),
    (True, None, 3.0, None),
    (False, None, 3.0, None),
    (None, None, 3.0, None),
    (True, 2.0, None, None),
]

SCHEMA = StructType(
    [
        StructField("is_recommended", BooleanType()),
        StructField("hours", FloatType()),
        StructField("avg_hours", DoubleType()),
        StructField("expected", DoubleType()),
    ]
)


def test_spark_rule_on_edge_rows(spark):
    rows = [(r, h, a, None if e is None else float(e)) for r, h, a, e in EDGE_ROWS]
    df = spark.createDataFrame(rows, SCHEMA)
    got = df.select(rating_expr().alias("r"), "expected").collect()
    for row, src in zip(got, EDGE_ROWS):
        assert row["r"] == src[3], src


def test_no_python_udf_in_plan(spark):
    df = spark.createDataFrame([(True, 1.0, 2.0, None)], SCHEMA).select(rating_expr().alias("r"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _sql_lit(v, typ):
    if v is None:
        return f"CAST(NULL AS {typ})"
    if isinstance(v, float) and math.isnan(v):
        return f"CAST('NaN' AS {typ})"
    return f"CAST({v!r} AS {typ})" if typ != "BOOLEAN" else ("true" if v else "false")


def test_duckdb_rule_on_edge_rows():
    values = ", ".join(
        f"({_sql_lit(r, 'BOOLEAN')}, {_sql_lit(h, 'FLOAT')}, {_sql_lit(a, 'DOUBLE')})" for r, h, a, _ in EDGE_ROWS
    )
    sql = f"SELECT {rating_sql()} AS r FROM (VALUES {values}) AS t(is_recommended, hours, avg_hours)"
    got = [row[0] for row in duckdb.sql(sql).fetchall()]
    assert got == [e for *_, e in EDGE_ROWS]


@pytest.mark.parametrize("rec", [True, False, None])
def test_tie_branch(spark, rec):
    df = spark.createDataFrame([(rec, 3.0, 3.0, None)], SCHEMA)
    r = df.select(rating_expr().alias("r")).first()["r"]
    assert r == (4 if rec else None)
