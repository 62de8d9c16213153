"""Top-k: tie order, group limit, titles after the limit, rank gaps."""

from conftest import plan_text
from sparkrec.operators.recommend import candidate_pairs, ranked_titles, top_k, top_k_for_user, with_titles

P = "user_id int, item_id int, prediction double"


def _preds(spark):
    rows = [(1, i, float(s)) for i, s in [(5, 3.0), (3, 3.0), (4, 1.0), (9, 2.0), (7, 3.0)]]
    rows += [(2, i, 1.0) for i in range(1, 25)]
    return spark.createDataFrame(rows, P)


def test_ties_lower_item_first(spark):
    got = [(r["rank"], r["item_id"]) for r in top_k_for_user(_preds(spark), 1, 4).collect()]
    assert got == [(1, 3), (2, 5), (3, 7), (4, 9)]


def test_top_k_all_users(spark):
    df = top_k(_preds(spark), 3)
    got = sorted((r["user_id"], r["rank"], r["item_id"]) for r in df.collect())
    assert got == [(1, 1, 3), (1, 2, 5), (1, 3, 7), (2, 1, 1), (2, 2, 2), (2, 3, 3)]


def test_top_k_uses_group_limit(spark):
    df = top_k(_preds(spark), 3)
    df.collect()
    assert "WindowGroupLimit" in plan_text(df)


def test_top_k_for_user_is_take_ordered(spark):
    df = _preds(spark).filter("user_id = 1").orderBy("prediction").limit(2)
    df2 = top_k_for_user(_preds(spark), 1, 2)
    df2.collect()
    assert "TakeOrderedAndProject" in df2._jdf.queryExecution().executedPlan().toString()


def test_missing_title_leaves_a_gap(spark):
    titles = spark.createDataFrame([(3, "c"), (7, "g"), (9, "i")], "item_id int, title string")
    got = [(r["rank"], r["item_id"], r["title"]) for r in ranked_titles(_preds(spark), titles, 4, user_id=1).collect()]
    assert sorted(got) == [(1, 3, "c"), (3, 7, "g"), (4, 9, "i")]


def test_users_subset_semi_join(spark):
    users = spark.createDataFrame([(2,), (2,)], "user_id int")
    df = top_k(_preds(spark), 2, users=users)
    assert sorted((r["user_id"], r["rank"]) for r in df.collect()) == [(2, 1), (2, 2)]


def test_candidate_pairs_distinct(spark):
    df = spark.createDataFrame([(1, 2, 3.0), (1, 2, 4.0), (1, 3, 1.0)], "user_id int, item_id int, rating float")
    assert candidate_pairs(df).count() == 2


def test_titles_broadcast_when_small(spark):
    titles = spark.createDataFrame([(3, "c")], "item_id int, title string")
    df = with_titles(top_k(_preds(spark), 2), titles, titles_rows=1)
    df.collect()
    assert "BroadcastHashJoin" in plan_text(df)


class _Identity:
    def transform(self, pairs):
        from pyspark.sql import functions as F

        return pairs.withColumn("prediction", (F.col("item_id") % 7).cast("double"))


def test_recommend_for_a_set_of_users(spark):
    from sparkrec.operators.recommend import recommend

    cands = spark.createDataFrame([(u, i) for u in (1, 2, 3) for i in range(1, 15)] + [(2, 3)], "user_id int, item_id int")
    titles = spark.createDataFrame([(i, f"t{i}") for i in range(1, 15)], "item_id int, title string")
    users = spark.createDataFrame([(2,), (3,), (3,)], "user_id int")
    out = recommend(_Identity(), cands, titles, k=3, users=users).collect()
    assert sorted({r["user_id"] for r in out}) == [2, 3]
    per_user = [(r["rank"], r["item_id"]) for r in out if r["user_id"] == 2]
    assert sorted(per_user) == [(1, 6), (2, 13), (3, 5)]


def test_conflicting_scores_of_a_pair(spark):
    """A pair listed with two scores counts once, with the higher one, for one user and for all."""
    rows = [(1, 5, 3.0), (1, 5, 9.0), (1, 6, 4.0), (1, 7, 4.0), (1, 7, 1.0)]
    preds = spark.createDataFrame(rows, P)
    want = [(1, 5, 9.0), (2, 6, 4.0), (3, 7, 4.0)]
    one = [(r["rank"], r["item_id"], r["prediction"]) for r in top_k_for_user(preds, 1, 3).collect()]
    every = sorted((r["rank"], r["item_id"], r["prediction"]) for r in top_k(preds, 3).collect())
    assert one == every == want


def test_titles_side_uses_measured_bytes(spark):
    from sparkrec.operators.recommend import measured

    titles = spark.createDataFrame([(i, "x" * 40_000) for i in range(300)], "item_id int, title string")
    rows, size = measured(titles)
    assert (rows, size) == (300, 12_000_000)
    df = with_titles(top_k(_preds(spark), 2), titles, titles_rows=rows, titles_bytes=size)
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
