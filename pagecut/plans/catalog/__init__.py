"""Query catalog: every registered query with its DuckDB SQL twin.

Each domain module defines ``QUERIES`` (name -> ``fn(spark, root)`` returning
a DataFrame) and ``SQL`` (name -> SQL over the corpus views).  A query with
no SQL twin is checked on rows and by the property tests.  Doubles are
rounded to 6 digits on both sides and every column is aliased, so results
compare value by value.
"""

from __future__ import annotations

from pagecut.plans.catalog import (conversations, documents, embeddings, events, lineitem, metrics,
                                   misc, ml)

_MODULES = (events, documents, conversations, lineitem, metrics, embeddings, misc, ml)


def queries() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.SQL)
    return out
