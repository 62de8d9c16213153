"""Run by tests/test_retries.py in its own JVM (master local[4,3]: failed
tasks are retried). A filter that raises on the first attempt of one task
is put into the ratings stage and into the ALS input; the results must
equal a run without failures."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import BooleanType  # noqa: E402


MARKERS = os.environ["RETRY_MARKERS"]


@F.udf(BooleanType())
def flaky_keep(_):
    ctx = TaskContext.get()
    if ctx is not None and ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        open(os.path.join(MARKERS, f"fail-{ctx.stageId()}-{ctx.taskAttemptId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return True


def main(sf_dir: str) -> None:
    from sparkrec.operators import model as als
    from sparkrec.operators.evaluate import rmse_value
    from sparkrec.operators.ratings import derive_ratings
    from sparkrec.plans.session import Workspace
    from sparkrec.sources import tables

    spark = (
        SparkSession.builder.master("local[4,3]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    ws = Workspace(spark, "retry")
    inter = tables.interactions(spark, sf_dir)
    clean = ws.materialize(derive_ratings(inter, ws), "clean")
    flaky = ws.materialize(derive_ratings(inter.filter(flaky_keep("user_id")), ws).filter(flaky_keep("item_id")), "flaky")
    same_rows = clean.exceptAll(flaky).count() == 0 and flaky.exceptAll(clean).count() == 0

    cfg = als.AlsConfig(rank=3, iterations=2)
    a = rmse_value(als.fit(clean, cfg, ws), clean)
    b = rmse_value(als.fit(flaky.filter(flaky_keep("rating")), cfg, ws), clean)
    failures = len(os.listdir(MARKERS))
    print(json.dumps({"rows": clean.count(), "same_rows": same_rows, "rmse_clean": a, "rmse_retried": b,
                      "injected_failures": failures}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
