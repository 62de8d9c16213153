"""Ranked top-k lists and titles.

* ``top_k_for_user``: filter one user, sort, limit; the filter reaches the
  scan and sort + limit plan as ``TakeOrderedAndProject`` (a per-partition
  top-k merged on the driver side of the stage: k rows per task at most).
* ``top_k``: the same for every user, with ``dense_rank() <= k`` over a
  user window. Spark plans it as ``WindowGroupLimit`` partial *before* the
  shuffle and final after it, so no task receives more than
  ``k x map partitions`` rows of one user, however many rows a hot user has.
* ``with_titles``: inner join with titles after the limit (items without a
  title drop out; the ``rank`` column keeps order and shows gaps).

Ties in score are broken by the lower item id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.plans.joins import bounded_side

TOP_ROW_BYTES = 96


def side_bytes(titles_rows: int, titles_bytes: int) -> int:
    """Bytes a row of a titles side, from its measured text bytes."""
    return 64 + -(-titles_bytes // max(1, titles_rows))


def one_score_per_pair(predictions: DataFrame, user: str = "user_id", item: str = "item_id", score: str = "prediction") -> DataFrame:
    """One row per (user, item): its highest score."""
    return predictions.groupBy(user, item).agg(F.max(score).alias(score))


def _order(score: str, item: str):
    return [F.col(score).desc_nulls_last(), F.col(item).asc()]


def top_k_for_user(
    predictions: DataFrame,
    user_id: int,
    k: int = 10,
    user: str = "user_id",
    item: str = "item_id",
    score: str = "prediction",
) -> DataFrame:
    """``(user, rank, item, score)`` for one user, at most ``k`` rows; copies
    of a pair count once, with their highest score (among that user's rows only)."""
    mine = one_score_per_pair(predictions.filter(F.col(user) == F.lit(user_id)), user, item, score)
    one = mine.orderBy(*_order(score, item)).limit(k)
    w = Window.partitionBy(user).orderBy(*_order(score, item))
    return one.select(F.col(user), F.row_number().over(w).alias("rank"), F.col(item), F.col(score))


def top_k(
    predictions: DataFrame,
    k: int = 10,
    user: str = "user_id",
    item: str = "item_id",
    score: str = "prediction",
    users: DataFrame | None = None,
    from_model: bool = False,
) -> DataFrame:
    """``(user, rank, item, score)`` with ``rank <= k`` for every user (or for
    the users in ``users``, via a semi join that keeps no duplicate rows).

    Copies of one (user, item) pair count once, with their highest score, as
    in :func:`top_k_for_user`. Scores that a model has computed are a function
    of the pair; with ``from_model`` that contract saves the aggregate over
    all pairs: ``dense_rank`` over ``(score desc, item)`` gives copies the same
    rank, and only the at most ``k`` ranks per user are de-duplicated.
    """
    if users is not None:
        predictions = predictions.join(users.select(user), user, "left_semi")
    if not from_model:
        predictions = one_score_per_pair(predictions, user, item, score)
    w = Window.partitionBy(user).orderBy(*_order(score, item))
    ranked = predictions.select(F.col(user), F.col(item), F.col(score), F.dense_rank().over(w).alias("rank"))
    top = ranked.filter(F.col("rank") <= k).dropDuplicates([user, "rank"])
    return top.select(user, "rank", item, score)


def with_titles(
    top: DataFrame,
    titles: DataFrame,
    item: str = "item_id",
    title: str = "title",
    top_rows: int | None = None,
    titles_rows: int | None = None,
    titles_bytes: int = 0,
) -> DataFrame:
    """Inner join of a top-k table with ``(item, title)``.

    The side that is proven small is broadcast: the top-k rows of one user
    (``top_rows``, bounded by k) or a titles table of known size (its
    ``titles_rows`` and the bytes of their texts). Otherwise it is a shuffle
    join (AQE splits a hot item).
    """
    t = titles.select(item, title)
    if top_rows is not None:
        return bounded_side(top, top_rows, TOP_ROW_BYTES).join(t, item)
    if titles_rows is not None:
        return top.join(bounded_side(t, titles_rows, side_bytes(titles_rows, titles_bytes)), item)
    return top.join(t, item)


def ranked_titles(
    scored: DataFrame,
    titles: DataFrame,
    k: int = 10,
    user_id: int | None = None,
    user: str = "user_id",
    item: str = "item_id",
    score: str = "prediction",
    titles_rows: int | None = None,
    titles_bytes: int = 0,
    from_model: bool = False,
) -> DataFrame:
    """Top ``k`` of scored pairs per user (or for ``user_id``) with titles:
    ``(user, rank, item, title, score)``."""
    cols = [user, "rank", item, "title", score]
    if user_id is not None:
        top = top_k_for_user(scored, user_id, k, user, item, score)
        return with_titles(top, titles, item, top_rows=k).select(*cols)
    top = top_k(scored, k, user, item, score, from_model=from_model)
    return with_titles(top, titles, item, titles_rows=titles_rows, titles_bytes=titles_bytes).select(*cols)


def recommend(
    model,
    candidates: DataFrame,
    titles: DataFrame,
    k: int = 10,
    user_id: int | None = None,
    user: str = "user_id",
    item: str = "item_id",
    titles_rows: int | None = None,
    users: DataFrame | None = None,
    titles_bytes: int = 0,
) -> DataFrame:
    """Score the candidate pairs, keep each user's top ``k``, attach titles.

    Candidates are the pairs a user has already rated (the scored set of the
    original job); a pair rated twice is one list entry, not two (see
    :func:`top_k`). With ``user_id`` (one user) or ``users`` (a DataFrame of
    users; a left-semi join, so duplicates in it add nothing) the candidates
    are restricted *before* scoring, so only those users' pairs are scored.
    """
    pairs = candidates.select(user, item)
    if user_id is not None:
        pairs = pairs.filter(F.col(user) == F.lit(user_id))
    elif users is not None:
        pairs = pairs.join(users.select(user), user, "left_semi")
    return ranked_titles(model.transform(pairs), titles, k, user_id, user, item, titles_rows=titles_rows,
                         titles_bytes=titles_bytes, from_model=True)


def measured(titles: DataFrame, title: str = "title") -> tuple[int, int]:
    """``(rows, bytes of the texts)`` of a titles table."""
    row = titles.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(title)), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def candidate_pairs(candidates: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Distinct (user, item) pairs; de-duplicated map-side before the shuffle."""
    return candidates.select(user, item).dropDuplicates([user, item])


def title_list(recommendations: DataFrame, item: str = "item_id", title: str = "title") -> list[tuple[int, str]]:
    """One user's ranked ``[(item, title)]`` on the driver (at most k rows)."""
    return [(r[item], r[title]) for r in recommendations.orderBy("rank").select(item, title).collect()]
