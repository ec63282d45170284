"""Every query with a SQL twin equals DuckDB on the small corpus."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF_SMALL), con, SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_id", "user_id", "page_number", "segment_id"]
    assert df.count() > 0


def test_every_query_runs(spark):
    for name, fn in E.queries().items():
        if name in SQL:
            continue
        assert fn(spark, SF_SMALL).count() > 0, name
