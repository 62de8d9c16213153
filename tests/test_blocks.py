"""The solver's ratings in blocks: nothing that grows with the ratings is shuffled by a half-step."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from sparkrec.operators import factorize as fz
from sparkrec.operators import model as als
from sparkrec.plans.session import held

BUDGET = "spark.sql.adaptive.autoBroadcastJoinThreshold"


@pytest.fixture(scope="module")
def ratings(spark):
    """400 users, 300 items, item 0 in a fifth of all ratings, one pair rated three times."""
    rows = [(u, (u * 7 + n * n * 11) % 300 if n % 5 else 0, float(1 + (u + n) % 4)) for u in range(400) for n in range(15)]
    rows += [(3, 5, 1.0), (3, 5, 4.0), (3, 5, 4.0)]
    return spark.createDataFrame(rows, "user_id int, item_id int, rating float")


def _layout(spark, ws, ratings, solve, fixed, blocks, cap=None):
    counts = {k: ws.materialize(ratings.groupBy(k).agg(F.count(F.lit(1)).alias("n")), f"n_{k}") for k in (solve, fixed)}
    layout = fz.BlockLayout(ratings, solve, fixed, counts[solve], counts[fixed].count(), 2, blocks, cap, ws)
    factors = layout.stage(fz.initial_factors(counts[fixed].select(fixed), fixed, 2, 37), "f").table
    return layout, factors


def _exchanges(df) -> list[str]:
    df.write.format("noop").mode("overwrite").save()
    return [line for line in plan_text(df).splitlines() if "Exchange" in line and "Broadcast" not in line]


@pytest.mark.parametrize("budget", ["1k", "10m"])
def test_half_step_moves_no_ratings(spark, ws, ratings, budget):
    with held(spark, BUDGET, budget), held(spark, fz.UNION_AS_ONE, "false"):
        layout, factors = _layout(spark, ws, ratings, "user_id", "item_id", 4)
        assert layout.broadcast == (budget == "10m") and layout.hot is None
        got = layout.equations(factors, "rating")
        assert not _exchanges(got)
        assert got.rdd.getNumPartitions() == 4
        rows = got.collect()
        assert len(rows) == 400 and sum(r["n"] for r in rows) == ratings.count()


@pytest.mark.parametrize("budget", ["1k", "10m"])
def test_hot_key_is_summed_apart(spark, ws, ratings, budget):
    with held(spark, BUDGET, budget), held(spark, fz.UNION_AS_ONE, "false"):
        layout, factors = _layout(spark, ws, ratings, "item_id", "user_id", 4, cap=200)
        assert [r[0] for r in layout.hot.select("item_id").distinct().collect()] == [0]
        assert layout.cold.where("item_id = 0").isEmpty()
        got = {r["item_id"]: r for r in layout.equations(factors, "rating").collect()}
        plain = fz.normal_equations(ratings.join(factors, "user_id"), "item_id", "rating", 2)
        for r in plain.collect():
            for name, value in r.asDict().items():
                assert got[r["item_id"]][name] == pytest.approx(value, abs=1e-9)
        assert len(got) == plain.count()


def test_fit_in_blocks_equals_broadcast_and_leaves_the_last_sweep(spark, ws, ratings):
    plain = als.fit(ratings, als.AlsConfig(rank=2, iterations=3), ws)
    with held(spark, BUDGET, "1k"):
        made = set(ws.tables())
        blocked = als.fit(ratings, als.AlsConfig(rank=2, iterations=3, partitions=3), ws)
        left = {t[:7] for t in set(ws.tables()) - made if t.startswith(("als_x", "als_y"))}
        assert left == {"als_x3-", "als_y3-"}
    for a, b in ((plain.userFactors, blocked.userFactors), (plain.itemFactors, blocked.itemFactors)):
        a, b = ({r["id"]: r["features"] for r in t.collect()} for t in (a, b))
        assert a.keys() == b.keys()
        assert max(abs(x - y) for k in a for x, y in zip(a[k], b[k])) < 1e-9


def test_shuffled_interactions_are_not_dealt_again(spark, ws):
    """Orders beyond the broadcast budget: the join's own shuffle has dealt the rows; the ratings are the same."""
    from sparkrec.plans import queries

    from conftest import SF_TINY

    found = {}
    for budget in ("10m", "1k"):
        with held(spark, BUDGET, budget):
            dealt, materialize = [], ws.materialize
            ws.materialize = lambda df, name, *a, **k: (dealt.append((name, k.get("partitions"))), materialize(df, name, *a, **k))[1]
            rows = queries._ratings(spark, SF_TINY, ws).collect()
            ws.materialize = materialize
            found[budget] = sorted(map(tuple, rows)), dict(dealt)["interactions"]
    assert found["10m"][0] == found["1k"][0]
    assert found["10m"][1] and found["1k"][1] is None
