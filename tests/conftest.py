import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_TINY = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sparkrec.plans.session import local_session

    s = local_session(8, app_name="sparkrec-tests")
    yield s
    s.stop()


@pytest.fixture()
def ws(spark):
    from sparkrec.plans.session import Workspace

    with Workspace(spark, "test") as w:
        yield w


def plan_text(df) -> str:
    """Final physical plan as text (AQE plan after execution when available)."""
    return df._jdf.queryExecution().executedPlan().toString()
