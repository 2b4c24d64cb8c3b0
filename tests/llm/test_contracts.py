"""Registered queries beside their SQL on the smallest tables."""

import os
from collections import Counter

import pytest

pytest.importorskip("duckdb")

import __spark_entry__ as entry_points  # noqa: E402
from checks.compare import connect  # noqa: E402
from eventpipe.llm.queries import ORACLES, QUERIES  # noqa: E402

SF_DIR = os.environ.get("CHECK_SF_DIR", entry_points.SMOKE_DIR)

if not os.path.isdir(SF_DIR):
    pytest.skip("no test tables", allow_module_level=True)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_gives_what_its_sql_gives(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    names = sorted(frame.columns)
    ours = Counter(tuple(r) for r in frame.select(*names).collect())
    theirs = Counter(connect(SF_DIR).sql(f"SELECT {', '.join(names)} FROM ({ORACLES[name]})").fetchall())
    assert ours == theirs


def test_one_query_for_each_operator_and_the_pipeline():
    names = list(entry_points.queries())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names
