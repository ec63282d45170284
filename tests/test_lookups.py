"""Repeated label lookups, checks after writing, tagged set matching."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pagecut.operators import labels as L
from pagecut.operators import metrics as M
from pagecut.plans import catalog
from pagecut.session import scratch_path
from pagecut.sinks.files import committed, write_binary_files


def test_bucketed_store_is_not_shuffled(spark):
    targets = spark.createDataFrame([("a", i) for i in range(0, 5000, 7)] + [("b", 3), ("b", 3), ("c", 1)], "bundle string, page_number int")
    pages = spark.createDataFrame([("a", i) for i in range(0, 5000, 3)] + [("b", 3), ("b", 4), ("x", 0), (None, 1)], "bundle string, page_number int")
    path = scratch_path(spark, "store")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    L.write_bucketed_store(targets, name, path, 8)
    got = L.attach_labels_bucketed(pages, name)
    assert rows(got, "bundle", "page_number", "label") == rows(L.attach_labels(pages, targets), "bundle", "page_number", "label")
    plan = got._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Final Plan"):plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert spark.table(name).where("bundle = 'a'").count() == 5  # blocks of 1,024 pages


def test_labels_by_page_take_one_bundle(spark):
    targets = spark.createDataFrame([("a", 0), ("b", 1), ("b", 1)], "bundle string, page_number int")
    pages = spark.createDataFrame([(0,), (1,), (2,)], "page_number int")
    for bundle, want in (("a", [1, 0, 0]), ("b", [0, 1, 0]), ("none", [0, 0, 0])):
        assert [r.label for r in L.attach_labels_by_page(pages, targets, bundle).orderBy("page_number").collect()] == want


def test_lookup_of_chosen_and_unknown_bundles(spark):
    targets = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "bundle string, page_number int")
    ask = lambda *names: spark.createDataFrame([(n,) for n in names], "bundle string")
    assert rows(L.lookup_target_pages(targets, ask("a", "c", "a"))) == [("a", 0), ("c", 2)]
    with pytest.raises(KeyError, match="nobody"):
        L.lookup_target_pages(targets, ask("a", "nobody"))
    assert rows(L.lookup_target_pages(targets, ask("a", "nobody"), strict=False)) == [("a", 0)]


def test_target_pages_of_every_bundle(spark):
    """Every bundle's pages are looked up; one that is stored without a target page is not unknown."""
    root = scratch_path(spark, "tables")
    turns = [(c, t, "user" if t % 2 == 0 else "assistant") for c in range(7) for t in range(4)] + [(8, 0, "assistant"), (9, 0, None)]
    spark.createDataFrame([(*t, "") for t in turns], "conv_id long, turn int, role string, text string").write.parquet(f"{root}/conversations.parquet")
    got = rows(catalog.queries()["target_pages_of"](spark, root), "bundle", "page_number")
    assert got == sorted((f"conv_{c}", t) for c, t, role in turns if role == "user")


def test_written_against_expected(spark):
    path = scratch_path(spark, "written")
    files = spark.createDataFrame([(f"a/page_{i}.png", b"x") for i in (0, 2, 10, 1030)] + [("z/page_0.png", b"y")], "n string, c binary")
    write_binary_files(files.repartition(3), "n", "c", path)
    assert rows(committed(spark, path)) == rows(files.select("n", F.octet_length("c").cast("bigint")))
    expected = spark.createDataFrame([("a", i) for i in (0, 1, 2, 10)] + [("b", 0)], "bundle string, page int")
    got = {(r.bundle, r.block): r for r in L.verify_written(expected, committed(spark, path), "bundle", "page").collect()}
    a = got["a", 0]
    assert (a.paths, a.missing_pages, a.n_expected, a.n_written) == ([f"a/page_{i}.png" for i in (0, 2, 10)], [1], 4, 3)
    assert got["a", 1].unexpected_pages == [1030] and not got["a", 1].bundle_missing
    assert got["b", 0].bundle_missing and got["z", 0].unexpected_pages == [0] and len(got) == 4
    # a later write has its own list; a folder without a finished write has none
    write_binary_files(files.limit(1), "n", "c", path)
    assert committed(spark, path).count() == 1
    with pytest.raises(FileNotFoundError):
        committed(spark, path + "/a")


def test_tagged_matching_is_one_scan(spark):
    data = [("o", 1, "p"), ("o", 1, "t"), ("o", 1, "t"), ("o", 2, "p"), ("q", 3, "t"), ("q", 4, "-"), (None, 5, "p")]
    df = spark.createDataFrame(data, "b string, n int, k string")
    got = M.match_flags(df, F.col("k") == "p", F.col("k") == "t", ["b", "n"])
    assert rows(got) == rows(spark.createDataFrame([("o", 1, True, True), ("o", 2, True, False), ("q", 3, False, True), (None, 5, True, False)],
                                                   "b string, n int, x boolean, y boolean"))
    two = M.match_sets(df.where("k = 'p'").select("b", "n"), df.where("k = 't'").select("b", "n"), ["b", "n"])
    assert rows(two) == rows(got)
    path = scratch_path(spark, "lines")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = M.prf_of(M.match_flags(stored, F.col("k") == "p", F.col("k") == "t", ["b", "n"]), "b")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
