"""Ratings derivation: averages, join, rule, drop (FIXTURES.md §3 'Others')."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, SF_TINY, plan_text
from sparkrec.operators.ratings import derive_ratings, item_average
from sparkrec.sources import tables
from sparkrec.sources.schemas import INTERACTIONS

NAN = float("nan")


def _inter(spark, rows):
    return spark.createDataFrame(rows, INTERACTIONS)


def _collect(df):
    return sorted((r["user_id"], r["item_id"], r["rating"]) for r in df.collect())


def test_lone_reviews(spark, ws):
    df = _inter(spark, [(1, 10, 5.0, True), (2, 11, 5.0, False)])
    assert _collect(derive_ratings(df, ws)) == [(1, 10, 4.0)]


def test_item_with_one_nan_drops_all_its_rows(spark, ws):
    df = _inter(spark, [(1, 10, 1.0, True), (2, 10, NAN, True), (3, 10, 9.0, False), (4, 11, 2.0, True)])
    assert _collect(derive_ratings(df, ws)) == [(4, 11, 4.0)]


def test_null_item_and_null_user_are_absent(spark, ws):
    df = _inter(spark, [(1, None, 1.0, True), (None, 10, 1.0, True), (2, 10, 3.0, True), (3, 10, 1.0, False)])
    assert _collect(derive_ratings(df, ws)) == [(2, 10, 4.0), (3, 10, 1.0)]


def test_null_hours_gives_no_rating_and_is_skipped_by_average(spark, ws):
    df = _inter(spark, [(1, 10, None, True), (2, 10, 4.0, True), (3, 10, 2.0, False)])
    avg = item_average(df).first()["avg_hours"]
    assert avg == 3.0
    assert _collect(derive_ratings(df, ws)) == [(2, 10, 4.0), (3, 10, 1.0)]


def test_output_schema(spark, ws):
    df = derive_ratings(tables.interactions(spark, SF_TINY), ws)
    assert df.schema.simpleString() == "struct<user_id:int,item_id:int,rating:float>"


def test_counts_match_fixture_sf001(spark, ws):
    df = derive_ratings(tables.interactions(spark, SF_SMALL), ws)
    got = {r["rating"]: r["count"] for r in df.groupBy("rating").count().collect()}
    assert got == {1.0: 10011, 2.0: 10014, 3.0: 19999, 4.0: 19955}


def test_small_average_side_is_broadcast(spark, ws):
    df = derive_ratings(tables.interactions(spark, SF_TINY), ws)
    df.count()
    plan = plan_text(df)
    assert "BroadcastHashJoin" in plan and "BatchEvalPython" not in plan


def test_large_average_side_stays_shuffle_join(spark, ws):
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "1k")
    try:
        df = derive_ratings(tables.interactions(spark, SF_TINY), ws)
        # The explicit decision is a merge-join hint on the averages side.
        logical = df._jdf.queryExecution().analyzed().toString()
        assert "strategy=merge" in logical
        assert df.count() > 0
        assert "SortMergeJoin [item_id" in plan_text(df)
    finally:
        spark.conf.set(key, old)


def test_key_beyond_int_fails_even_without_ansi(spark):
    import pytest
    from pyspark.sql.types import LongType, StructField, StructType

    from sparkrec.functions.keys import checked_int

    big = spark.createDataFrame([(5,), (3000000000,)], StructType([StructField("k", LongType())]))
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            with pytest.raises(Exception, match="out of int range: 3000000000"):
                big.select(checked_int("k")).collect()
        assert [r[0] for r in big.filter("k < 10").select(checked_int("k")).collect()] == [5]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
