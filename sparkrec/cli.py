"""Command line for the three jobs.

    python -m sparkrec evaluate  --interactions reviews.csv
    python -m sparkrec tune      --interactions reviews.csv --ranks 4 7 10 13
    python -m sparkrec recommend --interactions reviews.csv --titles titles.csv \\
                                 --user 1001 --predictions-out out/predictions

Inputs are the review-log CSV (eight columns, header) and a titles CSV
(``app_id``, ``title`` plus any other columns); ``--tables DIR`` reads the
Parquet stand-ins instead. The session comes from ``spark-submit`` (or
``--local N`` for a local run); stages go under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session(args) -> SparkSession:
    if args.local:
        from sparkrec.plans.session import local_session

        return local_session(args.local)
    return SparkSession.builder.appName(f"sparkrec-{args.job}").getOrCreate()


def _inputs(spark, args):
    from sparkrec.sources import io, tables

    if args.tables:
        return tables.interactions(spark, args.tables), tables.titles(spark, args.tables)
    inter = io.read_interactions_csv(spark, args.interactions)
    titles = io.read_titles_csv(spark, args.titles, infer=args.infer_titles) if args.titles else None
    return inter, titles


def _config(args):
    from sparkrec.operators.model import AlsConfig

    return AlsConfig(
        rank=args.rank, iterations=args.iterations, reg=args.reg, seed=args.seed,
        user_blocks=args.blocks, item_blocks=args.blocks, solver=args.solver, nonnegative=args.nonnegative,
    )


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sparkrec")
    p.add_argument("job", choices=["evaluate", "tune", "recommend"])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--interactions", help="review-log CSV file or directory")
    src.add_argument("--tables", help="directory with lineitem/orders/part Parquet stand-ins")
    p.add_argument("--titles", help="titles CSV (recommend)")
    p.add_argument("--infer-titles", action="store_true", help="infer the titles CSV schema")
    p.add_argument("--rank", type=int, default=4)
    p.add_argument("--iterations", type=int, default=30)
    p.add_argument("--reg", type=float, default=0.3)
    p.add_argument("--seed", type=int, default=37)
    p.add_argument("--blocks", type=int, default=None, help="user and item blocks (needed by, and only for, --solver mllib)")
    p.add_argument("--solver", default="normal_equations", choices=["normal_equations", "mllib"])
    p.add_argument("--nonnegative", action="store_true", help="non-negative factors (--solver mllib)")
    p.add_argument("--weights", type=float, nargs=3, default=[6, 2, 2], help="train / validation / test")
    p.add_argument("--split-seed", type=int, default=37)
    p.add_argument("--ranks", type=int, nargs="+", default=[4, 7, 10, 13])
    p.add_argument("--regs", type=float, nargs="+", default=[0.1, 0.2, 0.3])
    p.add_argument("--iteration-list", type=int, nargs="+", default=[15, 30])
    p.add_argument("--parallelism", type=int, default=1, help="trials fitted at once (tune)")
    p.add_argument("--user", type=int, help="one user's list (recommend); all users if omitted")
    p.add_argument("--users", help="CSV with a user_id column: lists for those users (recommend)")
    p.add_argument("-k", type=int, default=10)
    p.add_argument("--predictions-out", help="write every scored pair here (recommend)")
    p.add_argument("--format", default="csv", choices=["csv", "parquet", "bucketed"], help="of --predictions-out and --predictions-in")
    p.add_argument("--predictions-in", help="rank the lists from predictions written before, without a fit (recommend)")
    p.add_argument("--rejects-out", help="write the lines of --interactions that do not parse whole here (Parquet)")
    p.add_argument("--out", help="write the job's result table here (Parquet)")
    p.add_argument("--local", type=int, help="run on local[N] instead of the submitted session")
    args = p.parse_args(argv)

    from sparkrec.operators.recommend import title_list
    from sparkrec.plans import jobs
    from sparkrec.plans.session import Workspace
    from sparkrec.sources.io import read_rejects, read_users_csv

    spark = _session(args)
    inter, titles = _inputs(spark, args)
    cfg = _config(args)
    ws = Workspace(spark, f"cli-{args.job}")
    if args.rejects_out:
        if not args.interactions:
            p.error("--rejects-out needs --interactions")
        read_rejects(spark, args.interactions).write.mode("overwrite").parquet(args.rejects_out)
    try:
        if args.job == "evaluate":
            result = jobs.evaluate_job(inter, ws, cfg, args.weights, args.split_seed)
        elif args.job == "tune":
            trials, best = jobs.tune_job(
                spark, inter, ws, cfg, args.ranks, args.regs, args.iteration_list, args.weights, args.split_seed,
                args.parallelism,
            )
            for row in trials.orderBy("trial_no").collect():
                print(json.dumps(row.asDict()))
            result = best
        else:
            if titles is None:
                p.error("recommend needs --titles or --tables")
            users = None
            if args.users:
                users = read_users_csv(spark, args.users)
            if args.predictions_in:
                result = jobs.lists_from_predictions(spark, args.predictions_in, args.format, titles, args.k, args.user)
            else:
                result = jobs.recommend_job(
                    inter, titles, ws, cfg, args.k, args.user, args.predictions_out, args.format, users
                )
        if args.out:
            result.write.mode("overwrite").parquet(args.out)
        elif args.job == "recommend" and args.user is None:
            row = result.agg(F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("rows")).first()
            print(json.dumps(row.asDict()))
        elif args.job == "recommend":
            for item, title in title_list(result):
                print(json.dumps({"item_id": item, "title": title}))
        else:
            order = {"evaluate": "split", "tune": "trial_no"}[args.job]
            for row in result.orderBy(order).collect():  # a few rows: splits or the best trial
                print(json.dumps(row.asDict()))
    finally:
        ws.drop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
