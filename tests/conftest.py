from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from docketworks.session import build_session, prepare  # noqa: E402
from docketworks.sources.scratch import Scratch  # noqa: E402
from docketworks.workspace import open_workspace  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
AS_OF = datetime(2024, 6, 1)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "docketworks-tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.driver.memory": "4g", "spark.log.level": "ERROR"},
    )
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def settings(request):
    """Every test starts from the runtime settings of the jobs."""
    if "spark" in request.fixturenames:
        prepare(request.getfixturevalue("spark"))


@pytest.fixture(scope="session")
def scratch(spark, tmp_path_factory):
    return Scratch(spark, str(tmp_path_factory.mktemp("scratch")))


@pytest.fixture(scope="session")
def workspace(spark):
    return open_workspace(spark, SF_DIR)


def rows_of(frame, *columns):
    """Rows as plain tuples, sorted, nulls first."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=lambda t: [(v is not None, v) for v in t])


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
