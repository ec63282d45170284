import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pagecut.session import get_spark
    s = get_spark(master="local[4]", conf={"spark.sql.shuffle.partitions": "8"})
    yield s


def rows(df, *cols):
    """Collected rows as sorted tuples (nulls sort first)."""
    cols = cols or df.columns
    key = lambda t: tuple((v is not None, v) for v in t)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=key)
