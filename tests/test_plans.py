"""Physical-plan properties: native paths stay in the JVM, scans prune."""

from pyspark.sql import functions as F

from conftest import SF_MID


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_paths_have_no_python(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for name in ("attach_labels", "bundle_to_pages", "segment_ranges", "bundle_prf", "image_gray",
                 "split_hash", "array_vector_roundtrip"):
        p = _plan(qs[name](spark, SF_MID))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_scan_pushdown_and_pruning(spark):
    import __spark_entry__ as E
    p = _plan(E.queries()["suffix_filter"](spark, SF_MID))
    assert "PushedFilters: [IsNotNull(p_name), StringEndsWith(p_name,ring)]" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in p


def test_flagship_window_is_partitioned(spark):
    from pagecut.operators.segments import segment_pages
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    seg = segment_pages(ev, ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", strategy="window")
    p = _plan(seg)
    assert "hashpartitioning(user_id" in p and "SinglePartition" not in p


def test_label_join_becomes_broadcast_at_run_time(spark):
    import __spark_entry__ as E
    df = E.queries()["attach_labels"](spark, SF_MID)
    df.write.format("noop").mode("overwrite").save()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final


def test_chunked_global_order_is_parallel(spark):
    from pagecut.operators.prefix import running_sums
    df = spark.read.parquet(f"{SF_MID}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    out = running_sums(df, {"r": F.lit(1)}, ["l_orderkey", "l_linenumber"], strategy="chunked", num_chunks=6)
    p = _plan(out)
    # the rows are windowed per chunk; only the per-chunk totals (<= 6 rows)
    # meet in one partition, for the carry-in window
    assert "hashpartitioning(__chunk" in p
    assert p.count("Exchange SinglePartition") == 1
    single = p[p.index("Exchange SinglePartition"):]
    assert "HashAggregate(keys=[__chunk" in single.splitlines()[1]
    assert out.agg(F.max("r")).first()[0] == df.count()


def test_partition_sizing():
    from pagecut.session import shuffle_partitions_for
    assert shuffle_partitions_for(100 << 40) == 819200
    assert shuffle_partitions_for(1 << 20) == 200
