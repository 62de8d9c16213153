"""Trials that run together, the two forms of the small solve, the write interval, threads."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_TINY, plan_text
from sparkrec.operators import factorize as fz
from sparkrec.operators import model as als
from sparkrec.operators.ratings import derive_ratings
from sparkrec.plans import jobs
from sparkrec.plans.session import Workspace
from sparkrec.sources import tables


@pytest.fixture(scope="module")
def ratings(spark):
    with Workspace(spark, "t-trials") as w:
        yield w.materialize(derive_ratings(tables.interactions(spark, SF_TINY), w), "r")


def _factors(model):
    return {("u", r["id"]): r["features"] for r in model.userFactors.collect()} | {("i", r["id"]): r["features"] for r in model.itemFactors.collect()}


def _worst(a, b):
    a, b = _factors(a), _factors(b)
    assert a.keys() == b.keys()
    return max(abs(x - y) for k in a for x, y in zip(a[k], b[k]))


def test_trials_together_equal_single_runs(ratings, ws):
    cfg = als.AlsConfig(rank=3)
    together = als.fit_grid(ratings, cfg, [2, 4], [0.1, 0.3, 0.7], ws)
    models = together.models()
    assert set(models) == {(r, n) for r in (0.1, 0.3, 0.7) for n in (2, 4)}
    for reg in (0.1, 0.7):
        alone = als.fit_path(ratings, cfg.with_params(reg=reg), [2, 4], ws)
        assert max(_worst(models[reg, n], alone[n]) for n in (2, 4)) < 1e-6
    held = ratings.withColumn("part", F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd"))
    errors = together.errors(held, "part")
    direct = models[0.3, 4].transform(held).groupBy("part").agg(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).alias("e")).collect()
    assert errors[0.3, 4] == pytest.approx({r["part"]: r["e"] for r in direct}, abs=1e-9)


@pytest.mark.parametrize("rank", [1, 2, 5, 8])
def test_both_solves_are_equal(spark, rank):
    rng = np.random.default_rng(rank)
    rows = []
    for i in range(40):
        m = rng.normal(size=(2 + i % 5, rank))
        a, b = m.T @ m, rng.normal(size=rank)
        rows.append([i, i % 2, len(m)] + [float(a[p, q]) for p, q in fz._pairs(rank)] + [float(x) for x in b])
    names = ["k int", "trial int", "n bigint"] + [f"a{p}_{q} double" for p, q in fz._pairs(rank)] + [f"b{p} double" for p in range(rank)]
    equations = spark.createDataFrame(rows, ", ".join(names))
    native = {r["k"]: tuple(r) for r in fz.solved(equations, "k", rank, [0.1, 0.5], 99).collect()}
    batched = {r["k"]: tuple(r) for r in fz.solved(equations, "k", rank, [0.1, 0.5], 0).collect()}
    assert native.keys() == batched.keys()
    for k in native:
        assert native[k] == pytest.approx(batched[k], rel=1e-9, abs=1e-9)


def test_no_python_at_rank_four(ratings, ws):
    counts = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    layout = fz.RatingsLayout(ratings, "user_id", "item_id", counts, counts.count(), 4, 5, None, ws)
    step = fz.half_step(layout, fz.initial_factors(counts.select("user_id"), "user_id", 4, 37), "item_id", "rating", 4, [0.3])
    assert not any(word in plan_text(step) for word in ("Python", "Pandas", "Arrow"))


def test_write_interval_leaves_the_result_and_fewer_tables(spark, ratings):
    made = {}
    for every in (1, 3):
        with Workspace(spark, "t-every") as w:
            names, stage = [], w.stage
            w.stage = lambda df, name, *a, **k: (names.append(name), stage(df, name, *a, **k))[1]
            model = als.fit(ratings, als.AlsConfig(rank=2, iterations=7, write_every=every), w)
            made[every] = (names, _factors(model))
            left = [t for t in w.tables() if t.startswith("als_x")]
            assert len(left) == 1 and left[0].startswith("als_x7-")
    assert [n for n in made[1][0] if n.startswith("als_x")] == [f"als_x{n}" for n in range(8)]
    assert [n for n in made[3][0] if n.startswith("als_x")] == ["als_x0", "als_x3", "als_x6", "als_x7"]
    a, b = made[1][1], made[3][1]
    assert max(abs(x - y) for k in a for x, y in zip(a[k], b[k])) < 1e-6


def test_threads_give_the_same_trials(spark, ws):
    """Four driver threads in one workspace: no stage of one is removed by another."""
    inter = ws.materialize(tables.interactions(spark, SF_TINY), "inter")
    args = dict(ranks=(2, 3, 4, 6), regs=(0.1, 0.3), iterations=(1, 3))
    one = jobs.tune_job(spark, inter, ws, als.AlsConfig(), **args)[0].orderBy("trial_no").collect()
    assert len(one) == 16
    for _ in range(3):
        many = jobs.tune_job(spark, inter, ws, als.AlsConfig(), parallelism=4, **args)[0].orderBy("trial_no").collect()
        for a, b in zip(one, many):
            assert a[:4] == b[:4] and a["validation_rmse"] == pytest.approx(b["validation_rmse"], abs=1e-9)
            assert (a["test_rmse"] is None) == (b["test_rmse"] is None)
