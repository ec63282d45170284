import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pagecut.operators.prefix import running_sums


def _data(spark, n=3000, hot_share=0.34, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if rnd.random() < hot_share else rnd.randint(1, 40)
        if rnd.random() < 0.02:
            key = None
        out.append((key, i, rnd.randint(0, 3)))
    return spark.createDataFrame(out, "k int, t long, v int")


@pytest.mark.parametrize("chunks", [1, 4, 7])
def test_keyed_chunked_equals_window(spark, chunks):
    df = _data(spark)
    vals = {"s": F.col("v"), "c": F.lit(1)}
    a = running_sums(df, vals, ["t"], ["k"], strategy="window")
    b = running_sums(df, vals, ["t"], ["k"], strategy="chunked", num_chunks=chunks)
    assert rows(a, "k", "t", "s", "c") == rows(b, "k", "t", "s", "c")


def test_global_chunked_equals_window(spark):
    df = _data(spark).repartition(5)
    a = running_sums(df, {"s": F.col("v")}, ["t"], strategy="window")
    b = running_sums(df, {"s": F.col("v")}, ["t"], strategy="chunked", num_chunks=6)
    assert rows(a, "t", "s") == rows(b, "t", "s")


def test_hot_key_is_split_over_chunks(spark):
    df = _data(spark, hot_share=0.9)
    out = running_sums(df, {"c": F.lit(1)}, ["t"], ["k"], strategy="chunked", num_chunks=8)
    hot = [r["c"] for r in out.where("k = 0").orderBy("t").collect()]
    assert hot == list(range(1, len(hot) + 1))


def test_auto_picks_chunked_for_hot_group(spark):
    df = _data(spark)
    a = running_sums(df, {"c": F.lit(1)}, ["t"], ["k"], strategy="auto", hot_rows=100)
    b = running_sums(df, {"c": F.lit(1)}, ["t"], ["k"], strategy="window")
    assert rows(a, "k", "t", "c") == rows(b, "k", "t", "c")


def test_empty_input(spark):
    df = spark.createDataFrame([], "k int, t long, v int")
    assert running_sums(df, {"s": F.col("v")}, ["t"], ["k"], strategy="chunked").count() == 0


def test_auto_splits_hot_and_cold(spark):
    df = _data(spark, n=4000, hot_share=0.4)
    a = running_sums(df, {"c": F.lit(1), "s": F.col("v")}, ["t"], ["k"], strategy="auto", hot_rows=500,
                     rows_per_chunk=300)
    b = running_sums(df, {"c": F.lit(1), "s": F.col("v")}, ["t"], ["k"], strategy="window")
    assert rows(a, "k", "t", "c", "s") == rows(b, "k", "t", "c", "s")
    g = running_sums(df, {"s": F.col("v")}, ["t"], strategy="auto", hot_rows=1000, rows_per_chunk=700)
    assert rows(g, "t", "s") == rows(running_sums(df, {"s": F.col("v")}, ["t"], strategy="window"), "t", "s")


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.sampled_from([None, 0, 0, 0, 1, 2, 3]), st.integers(-5, 5)),
                     min_size=1, max_size=200),
       chunks=st.integers(1, 9))
def test_property_chunked_equals_window(spark, data, chunks):
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(data)], "k int, t long, v int")
    vals = {"s": F.col("v"), "c": F.lit(1)}
    a = running_sums(df, vals, ["t"], ["k"], strategy="window")
    b = running_sums(df, vals, ["t"], ["k"], strategy="chunked", num_chunks=chunks)
    assert rows(a, "t", "s", "c") == rows(b, "t", "s", "c")
