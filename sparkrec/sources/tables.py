"""Stand-ins built from the TPC-H-like tables (``lineitem``, ``orders``, ``part``).

``interactions``: a customer's order line is a review of a part.

===============  ====================================
user_id          ``o_custkey`` as int (out of range fails)
item_id          ``l_partkey`` as int (out of range fails)
hours            ``l_quantity`` as float
is_recommended   ``l_returnflag <> 'R'``
===============  ====================================

joined on ``l_orderkey = o_orderkey``. ``titles``: ``p_partkey``, ``p_name``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.functions.keys import checked_int
from sparkrec.plans.joins import bounded_side, fits_broadcast

# Hashed-relation bytes per (o_orderkey, o_custkey) row for the size check.
ORDER_ROW_BYTES = 48


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str, order_id: bool = False) -> DataFrame:
    """Interactions from ``lineitem`` and ``orders``; only five columns are scanned.

    The orders side is broadcast only if its exact row count (read from the
    Parquet footers, no scan) fits the broadcast budget; otherwise this is a
    shuffle join, where AQE splits the partitions of a hot order key. With
    ``order_id`` the order's key is a fifth column.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    joined = lines.join(_orders_side(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        checked_int("o_custkey").alias("user_id"),
        checked_int("l_partkey").alias("item_id"),
        F.col("l_quantity").cast("float").alias("hours"),
        (F.col("l_returnflag") != F.lit("R")).alias("is_recommended"),
        *([F.col("l_orderkey").alias("order_id")] if order_id else []),
    )


def _orders_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return bounded_side(orders.select("o_orderkey", "o_custkey"), orders.count(), ORDER_ROW_BYTES)


def lie_in_few_files(spark: SparkSession, sf_dir: str) -> bool:
    """Whether the rows of :func:`interactions` lie as in ``lineitem``'s files (orders are broadcast), not as a shuffle deals them."""
    return fits_broadcast(spark, table(spark, sf_dir, "orders").count(), ORDER_ROW_BYTES)


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        checked_int("p_partkey").alias("item_id"), F.col("p_name").alias("title")
    )


def interactions_csv_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in with the eight columns and names of the review-log CSV."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate"
    )
    joined = lines.join(_orders_side(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        checked_int("l_partkey").alias("app_id"),
        F.lit(None).cast("int").alias("helpful"),
        F.lit(None).cast("int").alias("funny"),
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_returnflag") != F.lit("R")).alias("is_recommended"),
        F.col("l_quantity").cast("float").alias("hours"),
        checked_int("o_custkey").alias("user_id"),
        F.lit(None).cast("int").alias("review_id"),
    )


def faulty_csv_frame(spark: SparkSession, sf_dir: str, every: tuple[int, int, int, int]) -> DataFrame:
    """The review-log CSV with fields that do not parse: a flag where the item key leaves
    remainder 1 by the first number, hours (2, second), the user key (3, third), the item key (4, fourth)."""
    flag, hours, user, item = every
    frame = interactions_csv_frame(spark, sf_dir)
    at = lambda key, n, rest: F.col(key) % F.lit(n) == F.lit(rest)
    text = {c: F.col(c).cast("string") for c in frame.columns}
    text["is_recommended"] = F.when(at("app_id", flag, 1), "maybe").otherwise(text["is_recommended"])
    text["hours"] = F.when(at("app_id", hours, 2), "a lot").otherwise(text["hours"])
    text["app_id"] = F.when(at("app_id", item, 4), F.concat(F.lit("i"), text["app_id"])).otherwise(text["app_id"])
    text["user_id"] = F.when(at("user_id", user, 3), F.concat(F.lit("u"), text["user_id"])).otherwise(text["user_id"])
    return frame.select(*[text[c].alias(c) for c in frame.columns])


def titles_csv_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with the CSV's column names plus a few more, as a titles file has."""
    return table(spark, sf_dir, "part").select(
        checked_int("p_partkey").alias("app_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
    )
