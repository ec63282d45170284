"""Bundle source and page file sink: ranges, bad bundles, other stores, failed writes."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from pagecut.session import scratch_path
from pagecut.sinks.files import finished, write_binary_files
from pagecut.sources.bundles import WholeFile, plan_ranges, read_bundles
from pagecut.sources.stores import Store, resolved


def archive(pages):
    file = io.BytesIO()
    with zipfile.ZipFile(file, "w") as z:
        for name, page in pages:
            z.writestr(name, page)
    return file.getvalue()


def mounted(spark, tmp_path):
    """A folder under a mount table: a path that POSIX calls can't open."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.pagecuttest.link./in", f"file://{tmp_path}")
    return "viewfs://pagecuttest/in"


def test_ranges_pack_small_bundles_and_cut_large_ones():
    files = [("a", 10), ("b", 95), ("c", 250), ("d", 1), ("e", 0)]
    ranges = [r.bundles for r in plan_ranges(files, 100)]
    assert sorted(sum(ranges, [])) == [("a", 0, 1), ("b", 0, 1), ("c", 0, 3), ("c", 1, 3), ("c", 2, 3), ("d", 0, 1), ("e", 0, 1)]
    assert all(len(r) == 1 for r in ranges if r[0][2] > 1) and plan_ranges([], 100) == []


def test_bundles_on_a_mounted_store(spark, tmp_path):
    root = mounted(spark, tmp_path)
    pages = [(f"page_{i}", f"text {i}" * 40) for i in range(25)]
    rows = [("x/big.zip", archive(reversed(pages))), ("small.zip", archive(pages[:2])), ("none.zip", archive([])), ("bad + 100%.zip", b"PK but no archive"),
            (None, b"x"), ("null.zip", None), ("other.txt", b"not listed")]
    write_binary_files(spark.createDataFrame(rows, "n string, c binary").repartition(3), "n", "c", f"{root}/out")
    assert finished(resolved(spark, f"{root}/out")) == (5, sum(len(c) for n, c in rows if n and c))
    found = read_bundles(spark, f"{root}/out", target_bytes=300, report_errors=True)
    assert found.rdd.getNumPartitions() > 4
    got = {(r.pdf_name, r.page_number): r for r in found.collect()}
    assert {k for k in got if k[0] in ("big", "small")} == {("big", i) for i in range(25)} | {("small", 0), ("small", 1)}
    assert all(bytes(got["big", i].content).decode() == pages[i][1] for i in range(25))
    assert got["bad + 100%", None].error and got["bad + 100%", None].content is None and len(got) == 28
    assert {r.pdf_name for r in read_bundles(spark, f"{root}/out").collect()} == {"big", "small"}
    split = read_bundles(spark, f"{root}/out", WholeFile(lambda data: data.split(b" ")), ".txt")
    assert [(r.page_number, bytes(r.content)) for r in split.orderBy("page_number").collect()] == [(0, b"not"), (1, b"listed")]


def test_images_on_a_mounted_store(spark, tmp_path):
    from pagecut.functions.image import png_udf
    from pagecut.plans.jobs import image_pages
    root = mounted(spark, tmp_path)
    px = spark.range(5).select(F.format_string("b%d/page_%d.png", F.col("id") % 2, "id").alias("name"),
                               png_udf(2, 2)(F.array(*[(F.col("id") * 10 + i).cast("int") for i in range(4)])).alias("png"))
    write_binary_files(px, "name", "png", f"{root}/img")
    got = {(r.pdf_name, r.page_number): [round(x * 255) for x in r.features] for r in image_pages(spark, f"{root}/img", (2, 2)).collect()}
    assert got == {(f"b{i % 2}", i): [i * 10 + k for k in range(4)] for i in range(5)}


def test_write_again_and_failed_write(spark):
    path = scratch_path(spark, "files")
    rows = spark.range(20).select(F.format_string("f%d", "id").alias("n"), F.col("id").cast("string").cast("binary").alias("c"))
    write_binary_files(rows, "n", "c", path)
    write_binary_files(rows, "n", "c", path)
    local = resolved(spark, path)
    assert sorted(p.rsplit("/", 1)[1] for p, _ in Store(local).files()) == sorted(f"f{i}" for i in range(20)) and finished(local) == (20, 30)
    bad = rows.withColumn("c", F.when(F.col("n") == "f13", F.raise_error(F.lit("torn")).cast("binary")).otherwise(F.col("c")))
    with pytest.raises(Exception, match="torn"):
        write_binary_files(bad, "n", "c", path)
    assert finished(local) is None
    assert not [f for _, _, names in os.walk(Store(local).root) for f in names if f.startswith(".f") and not f.endswith(".crc")]


def test_empty_folder(spark, tmp_path):
    assert read_bundles(spark, str(tmp_path)).collect() == []
