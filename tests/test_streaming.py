import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pagecut.session import scratch_path
from pagecut.sinks.files import _local
from pagecut.streaming import page_stream, write_page_stream


def test_restarted_stream_processes_only_new_files(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    src, sink, ckpt = (scratch_path(spark, n) for n in ("src", "sink", "ckpt"))
    first = docs.where("doc_id < 100")
    first.write.parquet(f"{src}/part1")

    def run():
        q = write_page_stream(page_stream(spark, src, docs.schema, "doc_id", "text", pattern="*.parquet")
                              .withColumn("n", F.lit(1)), sink, ckpt)
        q.awaitTermination()

    spark.conf.set("spark.sql.streaming.schemaInference", "false")
    # the stream reads files at the top of the source folder: move the part files there
    for d in os.listdir(_local(f"{src}/part1")):
        if d.endswith(".parquet"):
            os.replace(os.path.join(_local(f"{src}/part1"), d), os.path.join(_local(src), "a-" + d))
    run()
    n1 = spark.read.parquet(sink).count()
    rest = docs.where("doc_id >= 100")
    rest.write.parquet(f"{src}/part2")
    for d in os.listdir(_local(f"{src}/part2")):
        if d.endswith(".parquet"):
            os.replace(os.path.join(_local(f"{src}/part2"), d), os.path.join(_local(src), "b-" + d))
    run()
    out = spark.read.parquet(sink)
    expect = docs.select(F.size(F.split("text", "\n")).alias("k")).agg(F.sum("k")).first()[0]
    assert n1 < out.count() == expect
    assert out.groupBy("doc_id", "page_number").count().where("count > 1").count() == 0


def test_binary_writer_rejects_remote_roots():
    import pytest
    with pytest.raises(ValueError):
        _local("hdfs://nn/x")
    assert _local("file:///tmp/x") == "/tmp/x" and _local("/tmp/y") == "/tmp/y"
