"""A hot item holding a large share of all rows, end to end.

Line 1 of every order is re-keyed to one item, so that item has about 15%
of all interactions (vs. 0.5% for a typical item at sf0.001). Ratings must still equal DuckDB's,
the solver's layout must spread the hot item over many salts, and every
user must get a list.
"""

import duckdb
from pyspark.sql import functions as F

from conftest import SF_TINY
from sparkrec.functions.rating import rating_sql
from sparkrec.operators import factorize as fz
from sparkrec.operators import model as als
from sparkrec.operators.ratings import derive_ratings
from sparkrec.operators.recommend import candidate_pairs, top_k

HOT_ITEM = 1


def _hot_interactions(spark):
    lines = spark.read.parquet(f"{SF_TINY}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF_TINY}/orders.parquet")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    item = F.when(F.col("l_linenumber") == 1, F.lit(HOT_ITEM)).otherwise(F.col("l_partkey").cast("int"))
    return joined.select(
        F.col("o_custkey").cast("int").alias("user_id"),
        item.alias("item_id"),
        F.col("l_quantity").cast("float").alias("hours"),
        (F.col("l_returnflag") != F.lit("R")).alias("is_recommended"),
    )


def _duck_ratings():
    sql = f"""
    WITH inter AS (
      SELECT CAST(o_custkey AS INT) AS user_id,
             CASE WHEN l_linenumber = 1 THEN {HOT_ITEM} ELSE CAST(l_partkey AS INT) END AS item_id,
             CAST(l_quantity AS FLOAT) AS hours, l_returnflag <> 'R' AS is_recommended
      FROM read_parquet('{SF_TINY}/lineitem.parquet') JOIN read_parquet('{SF_TINY}/orders.parquet')
        ON l_orderkey = o_orderkey),
    a AS (SELECT item_id, avg(hours) AS avg_hours FROM inter GROUP BY item_id),
    r AS (SELECT user_id, i.item_id, {rating_sql()} AS rating FROM inter i JOIN a USING (item_id))
    SELECT user_id, item_id, CAST(rating AS FLOAT) FROM r WHERE rating IS NOT NULL
    """
    return sorted(duckdb.sql(sql).fetchall())


def test_hot_item_pipeline(spark, ws):
    inter = _hot_interactions(spark)
    ratings = ws.materialize(derive_ratings(inter, ws), "hot_ratings")
    assert sorted(tuple(r) for r in ratings.collect()) == _duck_ratings()

    total = ratings.count()
    hot_rows = ratings.filter(F.col("item_id") == HOT_ITEM).count()
    assert hot_rows > total // 10  # the hot item really is hot

    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "1k")  # factor tables too big to broadcast: salted layout
    try:
        cap = total // 8
        cfg = als.AlsConfig(rank=3, iterations=3, reg=0.3, partitions=8, salt_cap=cap)

        counts = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
        layout = fz.RatingsLayout(ratings.select("user_id", "item_id", "rating"), "item_id", "user_id",
                                  counts, counts.count(), 3, 8, cap, ws)
        groups = layout.ratings.filter(F.col("item_id") == HOT_ITEM).groupBy("salt").count().collect()
        assert len(groups) >= hot_rows // cap
        assert max(g["count"] for g in groups) <= 2 * cap

        model = als.fit(ratings, cfg, ws)
        lists = top_k(model.transform(candidate_pairs(ratings)), 10)
        assert lists.select("user_id").distinct().count() == ratings.select("user_id").distinct().count()
    finally:
        spark.conf.set(key, old)


def test_hot_item_join_is_split(spark, ws):
    """Averages joined back without a broadcast: half of all rows are one item's, its partition is split."""
    from conftest import plan_text
    from sparkrec.plans.queries import _averaged

    inter = _hot_interactions(spark)
    inter = inter.withColumn("item_id", F.when(F.col("user_id") % 2 == 0, F.lit(HOT_ITEM)).otherwise(F.col("item_id")))
    inter = inter.select("*", *[F.lit(f"{'x' * 20}").alias(f"wide{j}") for j in range(3)])
    keys = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        joined = _averaged(inter, ws)
        assert len(joined.collect()) == inter.count()
        assert "skew=true" in plan_text(joined).split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
