"""Bucketed predictions prune to one bucket; lines that do not parse are kept as rejects."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_TINY, plan_text
from sparkrec.cli import main
from sparkrec.plans import jobs
from sparkrec.sources import io, tables


def _scores(spark, n=3000):
    rows = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("user_id"),
                                 (F.col("id") % 200).cast("int").alias("item_id"), (F.rand(1) * 5).cast("float").alias("prediction"))
    return rows.dropDuplicates(["user_id", "item_id"])


def test_one_user_reads_one_bucket(spark, ws):
    scores = ws.materialize(_scores(spark), "scores")
    path = ws.location("bucketed")
    io.write_predictions(scores, path, "bucketed", 16)
    back = io.read_predictions(spark, path, "bucketed")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, scores.collect()))
    one = back.where("user_id = 7")
    assert one.count() == scores.where("user_id = 7").count() > 100
    # buckets are shown for scans that keep them apart; files are pruned in either case
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    assert "SelectedBucketsCount: 1 out of 16" in plan_text(one.select("*"))
    # another session's catalog does not know the table: it is made over the folder
    spark.sql(f"DROP TABLE {io._bucket_table(path)}")
    again = io.read_predictions(spark, path, "bucketed").where("user_id = 7")
    assert "SelectedBucketsCount: 1 out of 16" in plan_text(again)
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    titles = spark.range(200).select(F.col("id").cast("int").alias("item_id"), F.col("id").cast("string").alias("title"))
    got = jobs.lists_from_predictions(spark, path, "bucketed", titles, 5, 7).orderBy("rank").collect()
    want = scores.where("user_id = 7").orderBy(F.col("prediction").desc(), "item_id").limit(5).collect()
    assert [r["item_id"] for r in got] == [r["item_id"] for r in want]


def test_bucketed_overwrite_and_unknown_format(spark, ws):
    path = ws.location("twice")
    for n in (300, 100):
        scores = ws.materialize(_scores(spark, n), "scores")
        io.write_predictions(scores, path, "bucketed", 4)
        assert io.read_predictions(spark, path, "bucketed").count() == scores.count()
    with pytest.raises(ValueError):
        io.write_predictions(scores, path, "orc")


HEADER = "app_id,helpful,funny,date,is_recommended,hours,user_id,review_id"
LINES = {
    "1,0,0,2020-01-02,true,1.5,10,100": None,
    "2,0,0,2020-01-02,maybe,1.5,10,100": "malformed",
    "3,0,0,not a date,true,1.5,10,100": "malformed",
    "4,0,0,2020-01-02,true,long,10,100": "malformed",
    "5,0,0,2020-01-02,true": "malformed",
    "6,0,0,2020-01-02,true,1.5,10,100,7,8": "malformed",
    "7,0,0,2020-01-02,true,1.5,ten,100": "user_id",
    "x8,0,0,2020-01-02,true,1.5,10,100": "app_id",
    "x9,0,0,2020-01-02,true,1.5,ten,100": "user_id",
    "10,,,,,,,": None,
}


def test_rejects_of_a_fixture(spark, tmp_path, capsys):
    path = tmp_path / "log.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    rows = io.read_rejects(spark, str(path)).collect()
    assert sorted((r["app_id"], r["reason"]) for r in rows) == sorted((line.split(",")[0], why) for line, why in LINES.items() if why)
    assert {r["record"] for r in rows} == {line for line, why in LINES.items() if why == "malformed"} | {None}
    assert io.read_rejects(spark, str(path)).where("app_id = 2").first()["is_recommended"] is None
    assert io.read_interactions_csv(spark, str(path)).count() == len(LINES)  # reading itself keeps all lines


def test_rejects_and_stored_predictions_by_command(spark, tmp_path, capsys):
    inter, titles = str(tmp_path / "reviews"), str(tmp_path / "games")
    io.write_csv(tables.faulty_csv_frame(spark, SF_TINY, (97, 101, 89, 83)), inter)
    io.write_csv(tables.titles_csv_frame(spark, SF_TINY), titles)
    out, bad = str(tmp_path / "pred"), str(tmp_path / "rejects")
    common = ["recommend", "--interactions", inter, "--titles", titles, "--local", "8", "--user", "7", "--format", "bucketed"]
    assert main([*common, "--iterations", "2", "--predictions-out", out, "--rejects-out", bad]) == 0
    first = capsys.readouterr().out
    assert main([*common, "--predictions-in", out]) == 0
    assert first == capsys.readouterr().out and "item_id" in first
    assert spark.read.parquet(bad).count() == io.read_rejects(spark, inter).count() > 0
