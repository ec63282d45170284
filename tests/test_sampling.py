import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, rows
from pagecut.operators.sampling import oversample_minority, split_exact, split_hash, split_stratified
from pagecut.plans import standins as S


def test_hash_split_stable_under_repartition(spark):
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id")
    a = rows(split_hash(e, "vec_id"))
    b = rows(split_hash(e.repartition(7), "vec_id"))
    assert a == b
    assert {s for _, s in a} == {"train", "test"}


def test_exact_split_size_and_strata(spark):
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id", "label")
    s = split_exact(e, "vec_id", strategy="chunked")
    assert s.where("split = 'test'").count() == 100
    st = split_stratified(e, "vec_id", "label", strategy="chunked")
    sizes = {r["label"]: r["n"] for r in e.groupBy("label").agg(F.count("*").alias("n")).collect()}
    for r in st.where("split = 'test'").groupBy("label").agg(F.count("*").alias("t")).collect():
        assert r["t"] == -(-sizes[r["label"]] * 20 // 100)
    assert rows(split_exact(e.repartition(3), "vec_id", strategy="window")) == rows(s)


def test_oversample_bounds(spark):
    e = S.embedding_rows(spark, SF_MID).select("vec_id", "y")
    n0 = e.where("y = 0").count()
    o = oversample_minority(e, "y", "vec_id")
    n1 = o.where("y = 1").count()
    assert abs(n1 - n0) <= e.where("y = 1").count()
    assert o.where("y = 0").count() == n0


def test_oversample_without_minority_fails_early(spark):
    df = spark.createDataFrame([(1, 0)], "id int, y int")
    with pytest.raises(ValueError):
        oversample_minority(df, "y", "id")


def test_oversample_large_ratio_in_blocks(spark):
    from pagecut.operators import sampling
    df = spark.range(0, 9000).select(F.col("id").alias("vec_id"), F.lit(0).alias("y")) \
        .union(spark.createDataFrame([(100000, 1)], "vec_id long, y int"))
    old = sampling.COPY_BLOCK
    sampling.COPY_BLOCK = 1000
    try:
        o = oversample_minority(df, "y", "vec_id")
        minor = o.where("y = 1")
        assert minor.count() == 9000
        assert minor.select("copy").distinct().count() == 9000
    finally:
        sampling.COPY_BLOCK = old
