"""Helpers shared by the operators: input columns, word rules, scratch tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkrec.plans.session import Workspace

# Words are runs of anything but space, tab, newline, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
FIRST_ID = -(1 << 63)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pick(docs: DataFrame, **columns: str) -> DataFrame:
    """``docs`` reduced to the named columns under fixed names: ``pick(d, doc_id="id", text="body")``."""
    kinds = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string"}
    return docs.select(*[docs[f"`{name}`"].cast(kinds[to]).alias(to) for to, name in columns.items()])


def scratch(spark: SparkSession, name: str) -> Workspace:
    """A fresh folder under the cluster's shared checkpoint folder."""
    return Workspace(spark, name)


_KEPT: dict = {}


def kept(key: tuple, make: Callable):
    """``make()``, kept by this process until another key is asked for: a worker that
    serves one operator after the other holds one model or cache at a time."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def last_draws(drawn: DataFrame, most: int) -> dict:
    """Per ``kind`` the ``most``-th smallest ``draw`` (or the largest).

    Only draws under a share of the hash range in which about twice as many are
    expected are sorted; kinds with fewer there are looked at again with a
    larger share.
    """
    sizes = {r["kind"]: r["n"] for r in drawn.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    limits: dict = {}
    share = 2.0
    while left := {x: n for x, n in sizes.items() if x not in limits}:
        cuts = {x: int(-(1 << 63) + min(1.0, share * most / n) * ((1 << 64) - 2048)) for x, n in left.items()}
        cut = F.create_map(*[F.lit(v) for x, c in cuts.items() for v in (x, c if share * most < left[x] else (1 << 63) - 1)])
        near = drawn.where(F.col("draw") <= cut[F.col("kind")]).groupBy("kind", "draw").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("kind").orderBy("draw"))
        found = near.withColumn("upto", upto).where(F.col("upto") - F.col("n") < most).groupBy("kind").agg(F.max("draw").alias("last"), F.sum("n").alias("n"))
        limits |= {r["kind"]: r["last"] for r in found.collect() if r["n"] >= min(most, left[r["kind"]])}
        share *= 16
    return limits


def hash_buckets(rows: int, per_bucket: int = 20_000) -> int:
    """How many buckets keep about ``per_bucket`` rows each; grows with the table."""
    return max(1, math.ceil(rows / per_bucket))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (an inlined column would be
    computed again for each element of an inner lambda)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first_not_below(keys: Column, value: Column) -> Column:
    """Index of the first of the sorted digests that is at least ``value`` (binary search)."""

    def step(s, _):
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        return let(mid, lambda m: F.when(s["lo"] >= s["hi"], s)
                   .when(F.get(keys, m) < value, F.struct((m + 1).alias("lo"), s["hi"].alias("hi")))
                   .otherwise(F.struct(s["lo"].alias("lo"), m.alias("hi"))))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(keys) + F.lit(1))).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(keys).alias("hi")), step, lambda s: s["lo"])


def range_bucket(rows: DataFrame, key: str, buckets: int) -> Column:
    """Which of about ``buckets`` equal key ranges a (non-null) key is in, cut at its quantiles.

    Ranges are numbered in key order; equal keys share one. One job over the
    key column; the driver gets one key per range.
    """
    if buckets <= 1:
        return F.lit(0)
    shares = [i / buckets for i in range(1, buckets)]
    cuts = rows.agg(F.percentile_approx(key, shares, 20 * buckets).alias("cuts")).first()["cuts"]
    if not cuts:
        return F.lit(0)
    # the number of cuts at or below the key
    return let(F.lit(sorted(set(cuts))), lambda edges: first_not_below(edges, F.col(key) + 1))
