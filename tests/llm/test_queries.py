"""The registered queries against their SQL, and the pipeline's stages."""

import os
import sys

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import ROOT, SF_TINY

sys.path.insert(0, os.path.join(ROOT, "scripts"))

import corpus_pipeline  # noqa: E402
from sparkrec.llm.common import scratch  # noqa: E402
from sparkrec.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, name):
    from check_oracle import compare

    assert compare(spark, SF_TINY, [name], verbose=False)[name][0] == "ok"


def test_all_operators_are_registered():
    from __spark_entry__ import queries

    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(queries())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    # the smallest table holds no secret: three of its longer texts get one
    planted = F.row_number().over(Window.orderBy(F.length("text").desc(), "doc_id")) <= 3
    marked = F.concat("text", F.lit(" password = "), F.sha2(F.col("doc_id").cast("string"), 256))
    docs = docs.withColumn("text", F.when(planted, marked).otherwise(F.col("text"))).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    ws = scratch(spark, "t-pipeline")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = ws.materialize(stage(spark, docs, SF_TINY), name)
        if name != "packing":
            assert out.columns == docs.columns
        if name == "jaccard_join":
            assert out.select("doc_id").distinct().count() == out.count() < docs.count()
        if name == "secrets":
            assert out.where("text like '%[SECRET]%'").count() > 0
            assert out.where(r"text rlike '[0-9a-f]{24}' or length(text) <> n_chars").count() == 0
        sizes.append(out.count())
        docs = out
    assert sizes[0] == sizes[1] + (sizes[0] - sizes[1]) and sizes[2] == sizes[1] and min(sizes) > 0
    assert docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0


@pytest.mark.parametrize("rows", ["none", "nulls"])
def test_pipeline_edges(spark, rows):
    """An empty table, and null texts, ids and sources beside extra columns with names used inside."""
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    docs = docs.limit(0) if rows == "none" else docs.where("doc_id < 40")
    extra = {"kept_id": F.lit(1), "draw": F.lit("x"), "holds": F.lit(None).cast("string"), "key": F.lit(2.0)}
    docs = docs.withColumns(extra)
    if rows == "nulls":
        blank = {c: F.when(F.col("doc_id") % 4 != k, F.col(c)) for k, c in ((1, "text"), (2, "source"))}
        docs = docs.withColumns(blank).unionByName(docs.where("doc_id < 3").withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType)))
    ws = scratch(spark, "t-edges")
    for name, stage in corpus_pipeline.STAGES:
        out = ws.materialize(stage(spark, docs, SF_TINY), name)
        if name != "packing":
            assert out.columns == docs.columns
        if name == "language_id":
            assert out.where("text is null").count() == 0 and out.where("text is not null").count() == docs.where("text is not null").count()
        if rows == "none":
            assert out.count() == 0
        docs = out
