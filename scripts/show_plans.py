"""Print the final (adaptive) physical plan of each main stage.

Usage: python scripts/show_plans.py [sf_dir]
Each stage is collected first (small at sf0.01) so the printed plan is the
one AQE settled on; only the final plan is shown, with paths shortened.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_plan(df) -> str:
    import re

    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.split("== Initial Plan ==")[0].rstrip()
    return re.sub(r"\[file:[^\]]*\]", "[...]", text)


def main() -> None:
    from sparkrec.operators import model as als
    from sparkrec.operators.evaluate import rmse_by_split
    from sparkrec.operators.ratings import derive_ratings
    from sparkrec.operators.recommend import recommend
    from sparkrec.operators.split import assign_split, split_frames
    from sparkrec.plans.session import Workspace, local_session
    from sparkrec.sources import tables

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    with Workspace(spark, "plans") as ws:
        ratings = derive_ratings(tables.interactions(spark, sf), ws)
        stages = {"ratings (averages joined back, rule, null drop)": ratings}
        data = ws.materialize(assign_split(ratings), "split", partition_by=["split"])
        stages["split: validation part (partition prune)"] = split_frames(data)[1]
        model = als.fit(split_frames(data)[0], als.AlsConfig(iterations=5), ws)
        stages["rmse by split (scoring joins, grouped error)"] = rmse_by_split(model, data)
        titles = ws.materialize(tables.titles(spark, sf), "titles")
        stages["top-10 with titles, all users"] = recommend(model, data, titles, 10, titles_rows=titles.count())
        stages["top-10 with titles, one user"] = recommend(model, data, titles, 10, user_id=7)
        for name, df in stages.items():
            print(f"\n### {name}\n")
            print(final_plan(df))

        # The skew-safe solver's half-step with factors too big to broadcast:
        # ratings in a salted layout (every item with more than `cap`
        # ratings spread over salts), only the factor side is shuffled.
        from pyspark.sql import functions as F

        from sparkrec.operators import factorize as fz

        key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
        old = spark.conf.get(key)
        spark.conf.set(key, "1k")
        try:
            train = split_frames(data)[0].select("user_id", "item_id", "rating")
            counts = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
            layout = fz.RatingsLayout(train, "item_id", "user_id", counts, counts.count(), 4, 8, 10, ws)
            factors = fz.initial_factors(counts.select("item_id"), "item_id", 4, 37)
            step = fz.normal_equations(layout.join(factors), "user_id", "rating", 4)
            print("\n### skew-safe ALS half-step, factors not broadcast (salted layout, cap 10)\n")
            print(final_plan(step))
        finally:
            spark.conf.set(key, old)


if __name__ == "__main__":
    main()
