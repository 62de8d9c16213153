"""Registered queries: one per operator group, each over the whole tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns match the SQL of :mod:`sparkrec.plans.oracle`. The ALS solver is
compared by value: two sweeps at rank 2 written out (``als2_*``), and full runs,
the whole grid included, by a recursive query. A property table tells what SQL
does not say of a run. Other queries that need a score use the item-mean predictor.

A query's stages stay until the process ends: its rows are read from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.functions.rating import rating_expr
from sparkrec.operators import model as als
from sparkrec.operators.baseline import ItemMeanConfig, ItemMeanEstimator
from sparkrec.operators.evaluate import pair_predictions, rmse, rmse_by_split
from sparkrec.operators.ratings import derive_ratings, item_average, with_item_average
from sparkrec.operators.recommend import measured, ranked_titles, top_k, top_k_for_user
from sparkrec.operators.split import assign_split, split_frames
from sparkrec.operators.tune import best_trial, grid, run_grid
from sparkrec.plans import jobs
from sparkrec.plans.session import Workspace
from sparkrec.sources import io, tables

# Fixed values of the checks (not of the library).
TOP_K = 10
ONE_USER = 7
GRID_REGS = (1.0, 5.0, 25.0)
REFERENCE_ALS = als.AlsConfig(rank=4, iterations=30, reg=0.3, seed=37)
SMALL_ALS = REFERENCE_ALS.with_params(rank=2, iterations=2)
SMALL_GRID_REGS = (0.1, 0.3)
SMALL_GRID_ITERATIONS = (1, 2)
GRID_THREADS = 4
# One row in so many has a null flag, NaN hours or null hours in the edge query.
EDGE_EVERY = (97, 991, 89)
# One line in so many has a bad flag, bad hours, a bad user key or a bad item key.
REJECT_EVERY = (97, 101, 89, 83)
DIGITS = 6
# Scores of full runs: 60 half-steps add the same numbers in another order than SQL does.
FULL_DIGITS = 4


def _ws(spark: SparkSession) -> Workspace:
    return Workspace(spark, "query").drop_at_exit()


def q_interactions(spark, d):
    return tables.interactions(spark, d)


def q_interactions_csv(spark, d):
    ws = _ws(spark)
    path = ws.location("interactions_csv")
    io.write_csv(tables.interactions_csv_frame(spark, d), path)
    return io.read_interactions_csv(spark, path)


def q_interactions_rejects(spark, d):
    """Rejects of a review log with a bad flag, hours, user key or item key in some lines."""
    ws = _ws(spark)
    path = ws.location("interactions_bad_csv")
    io.write_csv(tables.faulty_csv_frame(spark, d, REJECT_EVERY), path)
    fields = ["app_id", "date", "is_recommended", "hours", "user_id"]
    return io.read_rejects(spark, path).select("reason", F.col("record").isNotNull().alias("has_record"), *fields)


def q_predictions_bucketed(spark, d):
    """The item-mean predictor's scores through the bucketed predictions table: one user's rows, ranked."""
    scored, ws = _scored_rated_pairs(spark, d)
    path = ws.location("predictions_bucketed")
    io.write_predictions(scored, path, "bucketed")
    out = jobs.lists_from_predictions(spark, path, "bucketed", tables.titles(spark, d), TOP_K, ONE_USER)
    return out.withColumn("prediction", _rounded("prediction", FULL_DIGITS))


def q_titles_csv_inferred(spark, d):
    ws = _ws(spark)
    path = ws.location("titles_csv")
    io.write_csv(tables.titles_csv_frame(spark, d), path)
    return io.read_titles_csv(spark, path, infer=True)


def q_titles_csv(spark, d):
    ws = _ws(spark)
    path = ws.location("titles_csv")
    io.write_csv(tables.titles_csv_frame(spark, d), path)
    return io.read_titles_csv(spark, path)


def q_item_avg_hours(spark, d):
    return item_average(tables.interactions(spark, d))


def _averaged(inter: DataFrame, ws: Workspace) -> DataFrame:
    """Interactions with their item's average: written, counted averages, so that a hot item's join is split."""
    inter = ws.materialize(inter, "interactions", partitions=int(inter.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    averages = ws.materialize(item_average(inter), "item_average")
    return with_item_average(inter, averages, averages_rows=averages.count())


def q_with_item_avg(spark, d):
    return _averaged(tables.interactions(spark, d), _ws(spark))


def q_rating_rule(spark, d):
    joined = _averaged(tables.interactions(spark, d), _ws(spark))
    return joined.select("user_id", "item_id", "hours", "is_recommended", "avg_hours", rating_expr().alias("rating"))


def q_rating_rule_edges(spark, d):
    """The rule with null flags and null or NaN hours put in by order and part keys."""
    flag, nan, null = EDGE_EVERY
    key, item = F.col("order_id"), F.col("item_id")
    hours = F.when(item % nan == 1, F.lit(float("nan"))).when((key + item) % null == 2, F.lit(None)).otherwise(F.col("hours"))
    inter = tables.interactions(spark, d, order_id=True)
    inter = inter.withColumn("is_recommended", F.when(key % flag == 0, F.lit(None)).otherwise(F.col("is_recommended")))
    inter = inter.withColumn("hours", hours.cast("float"))
    return _averaged(inter, _ws(spark)).select("order_id", "user_id", "item_id", "is_recommended", rating_expr().alias("rating"))


def _ratings(spark, d, ws=None) -> DataFrame:
    return derive_ratings(tables.interactions(spark, d), ws if ws is not None else _ws(spark), spread=tables.lie_in_few_files(spark, d))


def q_ratings(spark, d):
    return _ratings(spark, d)


def _split(spark, d, ws=None) -> DataFrame:
    ws = ws if ws is not None else _ws(spark)
    return ws.materialize(assign_split(_ratings(spark, d, ws)), "ratings_split", partition_by=["split"])


def q_holdout_split(spark, d):
    return _split(spark, d).select("user_id", "item_id", "rating", "split")


def q_rating_pairs(spark, d):
    return _ratings(spark, d).select("user_id", "item_id")


def _item_mean(data: DataFrame, ws: Workspace, reg: float = 0.0):
    return ItemMeanEstimator(ItemMeanConfig(reg=reg)).fit(data, ws)


def q_eval_pairs(spark, d):
    ws = _ws(spark)
    data = _split(spark, d, ws)
    model = _item_mean(split_frames(data)[0], ws)
    held_out = data.filter(F.col("split") != F.lit("train"))
    return model.transform(held_out).select(
        "user_id", "item_id", "rating", "split", F.round("prediction", DIGITS).alias("prediction")
    )


def q_rmse(spark, d):
    ws = _ws(spark)
    ratings = ws.materialize(_ratings(spark, d, ws), "ratings")
    model = _item_mean(ratings, ws)
    return rmse(model.transform(ratings)).select(F.round("rmse", DIGITS).alias("rmse"), "n")


def q_rmse_by_split(spark, d):
    ws = _ws(spark)
    data = _split(spark, d, ws)
    model = _item_mean(split_frames(data)[0], ws)
    return rmse_by_split(model, data).select("split", F.round("rmse", DIGITS).alias("rmse"), "n")


def _item_mean_grid(spark, d) -> DataFrame:
    ws = _ws(spark)
    data = _split(spark, d, ws)
    train, validation, test = split_frames(data)
    trials = run_grid(spark, train, validation, grid([None], GRID_REGS, [None]),
                      lambda df, t: _item_mean(df, ws, t.reg), test)
    return ws.materialize(trials, "trials")


def _rounded_trials(trials: DataFrame) -> DataFrame:
    return trials.select(
        "trial_no", "rank", "reg", "iterations",
        F.round("validation_rmse", DIGITS).alias("validation_rmse"),
        F.round("test_rmse", DIGITS).alias("test_rmse"),
    )


def q_grid_trials(spark, d):
    return _rounded_trials(_item_mean_grid(spark, d))


def q_grid_best(spark, d):
    return _rounded_trials(best_trial(_item_mean_grid(spark, d)))


def _scored_rated_pairs(spark, d) -> tuple[DataFrame, Workspace]:
    ws = _ws(spark)
    ratings = ws.materialize(_ratings(spark, d, ws), "ratings")
    model = _item_mean(ratings, ws)
    return model.transform(ratings.select("user_id", "item_id")), ws


def q_top_k_user(spark, d):
    scored, _ = _scored_rated_pairs(spark, d)
    top = top_k_for_user(scored, ONE_USER, TOP_K)
    return top.select("user_id", "rank", "item_id", F.round("prediction", DIGITS).alias("prediction"))


def q_top_k_all(spark, d):
    scored, _ = _scored_rated_pairs(spark, d)
    return top_k(scored, TOP_K, from_model=True).select("user_id", "rank", "item_id", F.round("prediction", DIGITS).alias("prediction"))


def q_top_k_titles(spark, d):
    scored, ws = _scored_rated_pairs(spark, d)
    titles = ws.materialize(tables.titles(spark, d), "titles")
    rows, size = measured(titles)
    out = ranked_titles(scored, titles, TOP_K, titles_rows=rows, titles_bytes=size, from_model=True)
    return out.select("user_id", "rank", "item_id", "title", F.round("prediction", DIGITS).alias("prediction"))


def q_top_k_titles_user(spark, d):
    scored, _ = _scored_rated_pairs(spark, d)
    out = ranked_titles(scored, tables.titles(spark, d), TOP_K, user_id=ONE_USER)
    return out.select("user_id", "rank", "item_id", "title", F.round("prediction", DIGITS).alias("prediction"))


def q_predictions_csv(spark, d):
    scored, ws = _scored_rated_pairs(spark, d)
    path = ws.location("predictions_csv")
    io.write_predictions(scored, path, "csv")
    return spark.read.option("header", True).schema("user_id int, app_id int, rating_points float").csv(path)


def q_eval_predictions(spark, d):
    """Actual ratings joined on the pair with the scores of a written predictions file."""
    ws = _ws(spark)
    ratings = ws.materialize(_ratings(spark, d, ws), "ratings")
    path = ws.location("predictions")
    io.write_predictions(_item_mean(ratings, ws).transform(ratings.select("user_id", "item_id")), path)
    return pair_predictions(ratings, io.read_predictions(spark, path))


# ---------------------------------------------------------------- ALS queries


def _als_ratings(spark, d) -> tuple[DataFrame, Workspace]:
    ws = _ws(spark)
    return ws.materialize(_ratings(spark, d, ws), "ratings"), ws


def _rounded(name: str, digits: int = DIGITS):
    return F.round(F.col(name).cast("double"), digits).alias(name)


def q_als2_factors(spark, d):
    ratings, ws = _als_ratings(spark, d)
    model = als.fit(ratings, SMALL_ALS, ws)
    parts = [t.select(F.lit(side).alias("side"), "id", *[F.round(F.col("features")[j], DIGITS).alias(f"f{j}") for j in range(2)])
             for side, t in (("user", model.userFactors), ("item", model.itemFactors))]
    return parts[0].union(parts[1])


def q_als2_scores(spark, d):
    ratings, ws = _als_ratings(spark, d)
    return als.score(als.fit(ratings, SMALL_ALS, ws), ratings).withColumn("prediction", _rounded("prediction"))


def q_als2_eval(spark, d):
    return jobs.evaluate_job(tables.interactions(spark, d), _ws(spark), SMALL_ALS, spread=tables.lie_in_few_files(spark, d)).select("split", _rounded("rmse"), "n")


def q_als2_lists(spark, d):
    out = jobs.recommend_job(tables.interactions(spark, d), tables.titles(spark, d), _ws(spark), SMALL_ALS, TOP_K,
                             spread=tables.lie_in_few_files(spark, d))
    return out.withColumn("prediction", _rounded("prediction"))


def _small_grid(spark, d):
    return jobs.tune_job(
        spark, tables.interactions(spark, d), _ws(spark), SMALL_ALS,
        ranks=(SMALL_ALS.rank,), regs=SMALL_GRID_REGS, iterations=SMALL_GRID_ITERATIONS,
        spread=tables.lie_in_few_files(spark, d),
    )


def q_als2_grid(spark, d):
    return _rounded_trials(_small_grid(spark, d)[0])


def q_als_scores(spark, d):
    ratings, ws = _als_ratings(spark, d)
    return als.score(als.fit(ratings, REFERENCE_ALS, ws), ratings).withColumn("prediction", _rounded("prediction", FULL_DIGITS))


def q_als_scored_pairs(spark, d):
    """How often each pair is scored by a full run."""
    return q_als_scores(spark, d).where("prediction is not null").groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n"))


def q_als_eval(spark, d):
    return jobs.evaluate_job(tables.interactions(spark, d), _ws(spark), REFERENCE_ALS, spread=tables.lie_in_few_files(spark, d)).select("split", _rounded("rmse"), "n")


def q_als_eval_rows(spark, d):
    return q_als_eval(spark, d).where("rmse > 0").select("split", "n")


def q_als_recommend(spark, d):
    ws = _ws(spark)
    out = jobs.recommend_job(tables.interactions(spark, d), tables.titles(spark, d), ws, REFERENCE_ALS, TOP_K,
                             spread=tables.lie_in_few_files(spark, d))
    return out.withColumn("prediction", _rounded("prediction", FULL_DIGITS))


def q_als_list_lengths(spark, d):
    """Rows and ranks of every user's list of a full run."""
    return q_als_recommend(spark, d).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("last_rank"))


def q_als_recommend_user(spark, d):
    ws = _ws(spark)
    out = jobs.recommend_job(
        tables.interactions(spark, d), tables.titles(spark, d), ws, REFERENCE_ALS, TOP_K, user_id=ONE_USER,
        predictions_path=ws.location("predictions"), predictions_format="bucketed",
        spread=tables.lie_in_few_files(spark, d),
    )
    return out.withColumn("prediction", _rounded("prediction", FULL_DIGITS))


def q_als_grid(spark, d):
    """All trials of the tuning job."""
    return _rounded_trials(jobs.tune_job(spark, tables.interactions(spark, d), _ws(spark), REFERENCE_ALS, parallelism=GRID_THREADS,
                                         spread=tables.lie_in_few_files(spark, d))[0])


def q_als_properties(spark, d):
    from sparkrec.operators.properties import als_properties

    ratings, ws = _als_ratings(spark, d)
    return als_properties(ratings, REFERENCE_ALS, ws)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "interactions": q_interactions,
    "interactions_csv": q_interactions_csv,
    "interactions_rejects": q_interactions_rejects,
    "predictions_bucketed": q_predictions_bucketed,
    "titles_csv_inferred": q_titles_csv_inferred,
    "titles_csv": q_titles_csv,
    "item_avg_hours": q_item_avg_hours,
    "with_item_avg": q_with_item_avg,
    "rating_rule": q_rating_rule,
    "ratings": q_ratings,
    "holdout_split": q_holdout_split,
    "rating_pairs": q_rating_pairs,
    "eval_pairs": q_eval_pairs,
    "rmse": q_rmse,
    "rmse_by_split": q_rmse_by_split,
    "grid_trials": q_grid_trials,
    "grid_best": q_grid_best,
    "top_k_user": q_top_k_user,
    "top_k_all": q_top_k_all,
    "top_k_titles": q_top_k_titles,
    "top_k_titles_user": q_top_k_titles_user,
    "predictions_csv": q_predictions_csv,
    "rating_rule_edges": q_rating_rule_edges,
    "eval_predictions": q_eval_predictions,
    "als2_factors": q_als2_factors,
    "als2_scores": q_als2_scores,
    "als2_eval": q_als2_eval,
    "als2_lists": q_als2_lists,
    "als2_grid": q_als2_grid,
    "als_properties": q_als_properties,
    "als_scores": q_als_scores,
    "als_scored_pairs": q_als_scored_pairs,
    "als_eval": q_als_eval,
    "als_eval_rows": q_als_eval_rows,
    "als_recommend": q_als_recommend,
    "als_list_lengths": q_als_list_lengths,
    "als_recommend_user": q_als_recommend_user,
    "als_grid": q_als_grid,
}
