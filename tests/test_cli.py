"""The command line over CSV inputs, as the original jobs were run."""

import json

import pytest

from conftest import SF_TINY
from sparkrec.cli import main
from sparkrec.sources import io, tables


def _csv_inputs(spark, tmp_path):
    inter, titles = str(tmp_path / "reviews"), str(tmp_path / "games")
    io.write_csv(tables.interactions_csv_frame(spark, SF_TINY), inter)
    io.write_csv(tables.titles_csv_frame(spark, SF_TINY), titles)
    return inter, titles


def _lines(capsys):
    return [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]


def test_evaluate_and_recommend_from_csv(spark, tmp_path, capsys):
    inter, titles = _csv_inputs(spark, tmp_path)
    common = ["--interactions", inter, "--local", "8", "--iterations", "5"]
    assert main(["evaluate", *common]) == 0
    assert [r["split"] for r in _lines(capsys)] == ["test", "train", "validation"]

    out = str(tmp_path / "pred")
    assert main(["recommend", *common, "--titles", titles, "--infer-titles", "--user", "7", "--predictions-out", out]) == 0
    rows = _lines(capsys)
    assert 0 < len(rows) <= 10 and all(set(r) == {"item_id", "title"} for r in rows)
    from sparkrec.operators.recommend import ranked_titles

    listed = ranked_titles(io.read_predictions(spark, out), tables.titles(spark, SF_TINY), 10, user_id=7)
    assert [r["item_id"] for r in rows] == [r["item_id"] for r in listed.orderBy("rank").collect()]
    assert io.read_predictions(spark, out).count() > 0


def test_tune_from_tables(spark, capsys):
    assert main(["tune", "--tables", SF_TINY, "--local", "8", "--ranks", "2", "--regs", "0.1", "0.3",
                 "--iteration-list", "3", "--parallelism", "2"]) == 0
    rows = _lines(capsys)
    assert len(rows) == 3  # two trials and the best
    assert rows[-1]["test_rmse"] is not None


def test_recommend_for_users_file(spark, tmp_path, capsys):
    users = tmp_path / "users.csv"
    users.write_text("user_id\n7\n10\n7\n")
    assert main(["recommend", "--tables", SF_TINY, "--local", "8", "--iterations", "3",
                 "--users", str(users)]) == 0
    summary = _lines(capsys)[-1]
    assert summary["users"] == 2 and 0 < summary["rows"] <= 20


@pytest.mark.parametrize("bad", ["3000000000", "seven"])
def test_bad_id_in_users_file_fails(spark, tmp_path, bad):
    users = tmp_path / "users.csv"
    users.write_text(f"user_id\n7\n{bad}\n")
    with pytest.raises(Exception, match="not a whole number"):
        main(["recommend", "--tables", SF_TINY, "--local", "8", "--iterations", "1", "--users", str(users)])
