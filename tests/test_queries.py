"""Every registered query beside its SQL, on the smallest tables."""

import os

import pytest

pytest.importorskip("duckdb")

import __spark_entry__ as entry_points  # noqa: E402
from checks.compare import compare, connect  # noqa: E402
from checks.oracles import ORACLES  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("CHECK_SF_DIR", entry_points.SMOKE_DIR)

if not os.path.isdir(SF_DIR):
    pytest.skip("no test tables", allow_module_level=True)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_gives_what_its_sql_gives(spark, con, name):
    assert compare(spark, con, SF_DIR, name) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["window_start", "window_end", "event_type", "event_count"]
    assert frame.count() > 0
