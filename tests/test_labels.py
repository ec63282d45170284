import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pagecut.operators import labels as L
from pagecut.session import scratch_path


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def test_store_roundtrip_edge_cases(spark):
    path = _local(scratch_path(spark, "store"))
    os.makedirs(path)
    store = {"a.pdf": {"target_pages": [0, 3, 3], "total_pages": 5},
             "empty": {"target_pages": [], "total_pages": 0}}
    with open(os.path.join(path, "store.json"), "w") as fh:
        json.dump(store, fh, indent=2)
    frag = L.read_label_store(spark, path, whole_file=True)
    assert rows(frag, "bundle", "total_pages") == [("a.pdf", 5), ("empty", 0)]
    t = L.read_store_targets(spark, path, whole_file=True)
    assert rows(t) == [("a.pdf", 0), ("a.pdf", 3)]          # duplicates removed
    tot = L.read_store_totals(spark, path, whole_file=True)
    exp = L.expected_pages(tot, "bundle")
    assert exp.where("bundle = 'empty'").count() == 0        # total 0 -> no page, never [0, -1]
    assert exp.where("bundle = 'a.pdf'").count() == 5
    with pytest.raises(KeyError):
        L.lookup_target_pages(t, spark.createDataFrame([("zzz",)], "bundle string"))


def test_missing_store_is_empty(spark):
    assert L.read_label_store(spark, "/nonexistent/store.json").count() == 0
    assert L.read_store_targets(spark, "/nonexistent/store.json").count() == 0


def test_written_store_lines_merge(spark):
    pages = spark.createDataFrame([("x", i, i in (0, 2)) for i in range(5)], "b string, p int, f boolean")
    store = L.build_label_store(pages, "b", "p", F.col("f"), block=2)   # 3 fragments
    path = scratch_path(spark, "store")
    L.write_label_store(store, path)
    assert rows(L.read_store_targets(spark, path)) == [("x", 0), ("x", 2)]
    assert rows(L.read_store_totals(spark, path)) == [("x", 5)]
    L.write_label_store(store, path + "-legacy", legacy=True)
    assert rows(L.read_store_targets(spark, path + "-legacy", legacy=True)) == [("x", 0), ("x", 2)]


def test_attach_default_zero_and_map_lookup(spark):
    pages = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "bundle string, page_number int")
    t = spark.createDataFrame([("a", 1), ("a", 1), ("zz", 0)], "bundle string, page_number int")
    assert rows(L.attach_labels(pages, t)) == [("a", 0, 0), ("a", 1, 1), ("b", 0, 0)]
    m = spark.createDataFrame([({1: 1},)], "m map<int,int>")
    got = m.select(L.map_get_default(F.col("m"), F.lit(1)).alias("x"), L.map_get_default(F.col("m"), F.lit(7)).alias("y"))
    assert got.first() == (1, 0)


def test_append_if_absent(spark):
    df = spark.createDataFrame([([1, 2],)], "a array<int>")
    assert df.select(L.append_if_absent(F.col("a"), F.lit(2))).first()[0] == [1, 2]
    assert df.select(L.append_if_absent(F.col("a"), F.lit(5))).first()[0] == [1, 2, 5]


def test_bundle_without_first_page_is_stored_empty(spark):
    pages = spark.createDataFrame([("x", 0, False), ("x", 1, False), ("y", 0, True)], "b string, p int, f boolean")
    store = L.build_label_store(pages, "b", "p", F.col("f"))
    got = {r["bundle"]: (r["target_pages"], r["total_pages"]) for r in store.collect()}
    assert got == {"x": ([], 2), "y": ([0], 1)}
