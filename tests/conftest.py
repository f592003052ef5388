import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from assocspark import new_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return new_session(8, app="tests")


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def values(df, column):
    """Values of one expression over a frame, in order."""
    return [row[0] for row in df.select(column).collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
