"""Benchmark: the three jobs on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Prints one JSON line: total seconds and seconds per query.

* ``ratings``        interactions (lineitem x orders) -> graded ratings, written
* ``split``          key-hash split, written partitioned by split
* ``evaluate``       ALS fit on train (rank 4, lambda 0.3, 30 it.) + RMSE per split
* ``recommend_all``  ALS fit on all ratings, score rated pairs, top-10 + titles, written
* ``recommend_user`` top-10 + titles for one user from the same model
* ``tune``           grid rank {4,7,10,13} x lambda {0.1,0.2,0.3} x iterations {15,30}:
                     all 24 trials through the tuning job

Before timing, the same code paths run once on the tiny sf0.001 tables
(JVM class loading and JIT); that warm-up is reported as ``warmup_sec`` in
``info`` and not counted in the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from pyspark.sql import functions as F

    from sparkrec.operators import model as als
    from sparkrec.operators.evaluate import rmse_by_split
    from sparkrec.operators.ratings import derive_ratings
    from sparkrec.operators.recommend import measured, recommend
    from sparkrec.operators.split import assign_split, split_frames
    from sparkrec.plans import jobs
    from sparkrec.plans.session import Workspace, local_session
    from sparkrec.sources import tables

    spark = local_session(cpus, app_name="sparkrec-bench")
    fit_cfg = als.AlsConfig(rank=4, iterations=30, reg=0.3, seed=37)
    times: dict[str, float] = {}
    info: dict[str, object] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        t0 = time.perf_counter()
        with Workspace(spark, "bench-warmup") as warm:
            r = warm.materialize(derive_ratings(tables.interactions(spark, warm_dir), warm), "ratings")
            r = warm.materialize(assign_split(r), "split", partition_by=["split"])
            m = als.fit(r, fit_cfg.with_params(iterations=2), warm)
            rmse_by_split(m, r).collect()
            recommend(m, r, tables.titles(spark, warm_dir), 10).count()
        info["warmup_sec"] = round(time.perf_counter() - t0, 3)

    with Workspace(spark, "bench") as ws:
        ratings = timed(
            "ratings", lambda: ws.materialize(derive_ratings(tables.interactions(spark, sf_dir), ws), "ratings")
        )
        info["ratings"] = ratings.count()
        data = timed("split", lambda: ws.materialize(assign_split(ratings), "split", partition_by=["split"]))
        train = split_frames(data)[0]

        def evaluate():
            model = als.fit(train, fit_cfg, ws)
            return {r["split"]: round(r["rmse"], 6) for r in rmse_by_split(model, data).collect()}

        info["rmse"] = timed("evaluate", evaluate)

        titles = ws.materialize(tables.titles(spark, sf_dir), "titles")
        n_titles, titles_bytes = measured(titles)
        state = {}

        def recommend_all():
            state["model"] = als.fit(ratings, fit_cfg, ws)
            out = recommend(state["model"], ratings, titles, 10, titles_rows=n_titles, titles_bytes=titles_bytes)
            return ws.materialize(out, "recommendations").count()

        info["recommendations"] = timed("recommend_all", recommend_all)
        user = ratings.agg(F.min("user_id")).first()[0]
        info["user_list"] = timed(
            "recommend_user", lambda: len(recommend(state["model"], ratings, titles, 10, user_id=user).collect())
        )

        def tune():
            _, best = jobs.tune_job(spark, tables.interactions(spark, sf_dir), ws, fit_cfg, parallelism=4)
            best = best.first()
            return {"rank": best["rank"], "reg": best["reg"], "iterations": best["iterations"], "validation_rmse": round(best["validation_rmse"], 6)}

        info["best"] = timed("tune", tune)

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_sec", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus, "info": info,
    }))


if __name__ == "__main__":
    main()
