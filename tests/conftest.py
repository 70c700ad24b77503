from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sluicegate.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "sluicegate-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": 4,
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def sf_medium():
    return f"{TESTDATA}/sf0.01"
