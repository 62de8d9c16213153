"""CSV sources and sinks: explicit schema, malformed rows, header check."""

import pytest

from conftest import SF_TINY
from sparkrec.sources import io, tables


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


HEADER = "app_id,helpful,funny,date,is_recommended,hours,user_id,review_id\n"


def test_malformed_fields_become_null(spark, tmp_path):
    p = _write(tmp_path, "a.csv", HEADER + "10,0,0,2020-01-01,maybe,x,7,1\n4,0\n11,1,1,2021-02-03,true,2.5,8,2\n")
    rows = sorted(io.read_interactions_csv(spark, p).collect(), key=lambda r: (r["item_id"] is None, r["item_id"]))
    assert [tuple(r) for r in rows] == [(None, 4, None, None), (7, 10, None, None), (8, 11, 2.5, True)]


def test_swapped_header_fails(spark, tmp_path):
    bad = "app_id,helpful,funny,date,is_recommended,hours,review_id,user_id\n1,0,0,2020-01-01,true,1.0,5,6\n"
    p = _write(tmp_path, "b.csv", bad)
    with pytest.raises(Exception, match="(?i)header|schema"):
        io.read_interactions_csv(spark, p).collect()


def test_pruned_scan(spark, tmp_path):
    p = _write(tmp_path, "c.csv", HEADER + "10,0,0,2020-01-01,true,1.0,7,1\n")
    plan = io.read_interactions_csv(spark, p)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<app_id:string,is_recommended:boolean,hours:float,user_id:string>" in plan


def test_interactions_round_trip(spark, tmp_path):
    src = tables.interactions_csv_frame(spark, SF_TINY)
    io.write_csv(src, str(tmp_path / "inter"))
    back = io.read_interactions_csv(spark, str(tmp_path / "inter"))
    want = tables.interactions(spark, SF_TINY)
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_titles_inferred_and_explicit(spark, tmp_path):
    io.write_csv(tables.titles_csv_frame(spark, SF_TINY), str(tmp_path / "t"))
    inferred = io.read_titles_csv(spark, str(tmp_path / "t"), infer=True)
    assert inferred.schema.simpleString() == "struct<item_id:int,title:string>"
    assert inferred.exceptAll(tables.titles(spark, SF_TINY)).count() == 0


def test_titles_by_header_name_without_inference(spark, tmp_path):
    text = "name_x,title,app_id,price\nq,Alpha,10,1.5\nr,Beta,x,2\ns,Gamma,3000000000,1\n"
    p = _write(tmp_path, "t.csv", text)
    with pytest.raises(Exception, match="out of int range"):
        io.read_titles_csv(spark, p).collect()
    ok = _write(tmp_path, "t2.csv", "name_x,title,app_id,price\nq,Alpha,10,1.5\nr,Beta,x,2\n")
    got = {r["title"]: r["item_id"] for r in io.read_titles_csv(spark, ok).collect()}
    assert got == {"Alpha": 10, "Beta": None}


def test_predictions_round_trip_and_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3.25), (4, 5, 0.5)], "user_id int, item_id int, prediction double")
    path = str(tmp_path / "pred")
    io.write_predictions(df, path)
    io.write_predictions(df.limit(1).orderBy("user_id"), path)
    back = io.read_predictions(spark, path)
    assert back.schema.simpleString() == "struct<user_id:int,item_id:int,prediction:float>"
    assert back.count() == 1
    io.write_predictions(df, path, "parquet")
    assert io.read_predictions(spark, path, "parquet").count() == 2


@pytest.mark.parametrize("row", ["10,0,0,2020-01-01,true,1.0,3000000000,1", "99999999999999999999,0,0,2020-01-01,true,1.0,7,1"])
def test_key_beyond_int_fails(spark, tmp_path, row):
    p = _write(tmp_path, "k.csv", HEADER + row + "\n")
    with pytest.raises(Exception, match="out of int range"):
        io.read_interactions_csv(spark, p).collect()


def test_unparsable_keys_are_counted(spark, tmp_path):
    p = _write(tmp_path, "u.csv", HEADER + "x,0,0,2020-01-01,true,1.0,7,1\n3,0,0,2020-01-01,true,1.0,1.5,1\n4,0\n")
    assert tuple(io.unparsable_keys(spark, p).first()) == (1, 1)


@pytest.mark.parametrize("infer", [False, True])
def test_unparsable_title_key_is_null(spark, tmp_path, infer):
    p = _write(tmp_path, "t3.csv", "app_id,title\n10,Alpha\nx,Beta\n")
    assert {r["title"]: r["item_id"] for r in io.read_titles_csv(spark, p, infer=infer).collect()} == {"Alpha": 10, "Beta": None}


def test_predictions_file_names(spark, tmp_path):
    """A file with the interchange header reads back, and ours has that header."""
    p = _write(tmp_path, "p.csv", "user_id,app_id,rating_points\n1,2,3.5\n")
    assert [tuple(r) for r in io.read_predictions(spark, p).collect()] == [(1, 2, 3.5)]
    out = str(tmp_path / "out")
    io.write_predictions(io.read_predictions(spark, p), out)
    assert spark.read.option("header", True).csv(out).columns == ["user_id", "app_id", "rating_points"]
