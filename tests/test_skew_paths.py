"""The skew-safe (chunked) paths give the same answers as the plain ones
on the corpus tables."""

import os
import sys

import numpy as np
from pyspark.sql import functions as F

from conftest import ROOT, SF_MID, rows
from pagecut.operators.prefix import running_sums
from pagecut.operators.profile import exact_percentiles
from pagecut.operators.segments import segment_pages

sys.path.insert(0, os.path.join(ROOT, "tools"))
from check_oracle import compare, duck  # noqa: E402


def test_flagship_chunked_equals_duckdb(spark):
    import __spark_entry__ as E
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    seg = segment_pages(ev, ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup",
                        strategy="chunked").select("event_id", "user_id", "page_number", "segment_id")
    ok, msg = compare(seg, duck(SF_MID), E.oracle_sql()["segment_pages"])
    assert ok, msg


def test_flagship_auto_with_every_bundle_hot(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    vals = {"page": F.lit(1), "seg": (F.col("event_type") == "signup").cast("int")}
    a = running_sums(ev, vals, ["ts", "event_id"], ["user_id"], hot_rows=20, rows_per_chunk=500)
    b = running_sums(ev, vals, ["ts", "event_id"], ["user_id"], strategy="window")
    assert rows(a, "event_id", "page", "seg") == rows(b, "event_id", "page", "seg")


def test_conversations_rebuilt_as_one_bundle(spark):
    c = spark.read.parquet(f"{SF_MID}/conversations.parquet").select("conv_id", "turn")
    seg = segment_pages(c, [], ["conv_id", "turn"], F.col("turn") == 0, number=False, strategy="chunked")
    got = {(r["conv_id"], r["segment_id"]) for r in seg.collect()}
    ids = sorted({cid for cid, _ in got})
    assert got == {(cid, i + 1) for i, cid in enumerate(ids)}      # segment k = k-th conversation


def test_exact_percentiles_chunked(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet").select("l_extendedprice")
    vals = np.array([r[0] for r in li.collect()])
    got = exact_percentiles(li, "l_extendedprice", [0.25, 0.5, 0.75], strategy="chunked")
    exp = np.percentile(vals, [25, 50, 75])
    assert np.allclose(got, exp, rtol=0, atol=1e-9)
