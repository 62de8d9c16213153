"""Every registered query with SQL matches DuckDB on sf0.001 (the driver's gate)."""

import os
import re
import sys

import pytest

from conftest import ROOT, SF_TINY

sys.path.insert(0, os.path.join(ROOT, "scripts"))


# The optional operators' queries have their own tests.
LLM = re.compile(r"op\d+_|pipeline$")


def _sql_names():
    from __spark_entry__ import oracle_sql

    return sorted(n for n in oracle_sql() if n != "als_properties" and not LLM.match(n))


@pytest.mark.parametrize("name", _sql_names())
def test_query_matches_duckdb(spark, name):
    from check_oracle import compare

    status = compare(spark, SF_TINY, [name], verbose=False)[name][0]
    assert status == "ok", status


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries

    missing = {n for n in set(queries()) - set(oracle_sql()) if not LLM.match(n)}
    assert not missing


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["user_id", "rank", "item_id", "title", "prediction"]
    assert df.count() > 0
