import contextlib
import io
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from careflow.session import build_session  # noqa: E402

# Whole plans, for the tests that look at them.
SETTINGS = {"spark.sql.maxMetadataStringLength": "10000", "spark.sql.debug.maxToStringFields": "1000"}
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "careflow-tests", master="local[4]", zone="Asia/Shanghai", settings=SETTINGS, state_on_disk=True
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return SMALL


def rows(df):
    """Rows as tuples in a fixed order."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan_of(df):
    """Text of the physical plan."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
