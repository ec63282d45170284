"""Raw files (``pages``), plain aggregates (``orders``) and the suffix filter
(``part``)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagecut.plans.catalog.common import r6
from pagecut.session import scratch_path
from pagecut.sinks import write_lines, write_parquet
from pagecut.sources.files import list_files, paths_frame
from pagecut.functions.udfs import null_on_error
from pagecut.sources.tables import table


def q_paths_frame(spark, root):
    return paths_frame(table(spark, root, "pages"), "url")


def q_default_label(spark, root):
    p = table(spark, root, "pages")
    return p.select(F.col("url").alias("path"), F.col("url").alias("image"), F.lit(0).alias("label"))


def q_text_roundtrip(spark, root):
    path = scratch_path(spark, "paths")
    write_lines(table(spark, root, "pages"), "url", path)
    return spark.read.text(path)


def q_scan_files(spark, root):
    pages = table(spark, root, "pages").withColumn("lang", F.regexp_extract("url", r"/([a-z]{2})/", 1))
    path = scratch_path(spark, "rawfiles")
    pages.select("lang", "html").write.mode("overwrite").partitionBy("lang").text(path)
    files = list_files(spark, path, "*.txt", recursive=True)
    # bytes per language folder do not depend on how the rows were split into files
    return files.groupBy(F.regexp_extract("path", r"lang=([^/]*)/", 1).alias("lang")) \
        .agg(F.sum("length").alias("n_bytes"), F.count(F.lit(1)).alias("n_files")).select("lang", "n_bytes")


def q_parquet_roundtrip(spark, root):
    path = scratch_path(spark, "parquet")
    write_parquet(table(spark, root, "embeddings"), path)
    back = spark.read.parquet(path)
    return back.select("vec_id", "label", F.size("embedding").alias("n"),
                       r6(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))).alias("total"))


def q_global_avg(spark, root):
    o = table(spark, root, "orders")
    return o.groupBy().agg(r6(F.avg("o_totalprice")).alias("avg_totalprice"), F.count(F.lit(1)).alias("n"))


def q_range_square(spark, root):
    """MTH2 on a corpus column: squares of the order keys."""
    from pagecut.sources.frames import square
    o = table(spark, root, "orders")
    return o.select("o_orderkey", square(F.col("o_orderkey")).alias("square"))


def q_suffix_filter(spark, root):
    return table(spark, root, "part").where(F.col("p_name").endswith("ring")).select("p_partkey", "p_name")


@null_on_error(T.IntegerType())
def _even_length(name):
    if len(name) % 2:
        raise ValueError(name)
    return len(name)


def q_null_on_error(spark, root):
    """A function that fails on some values: null and the reason there, the job goes on."""
    c = table(spark, root, "customer").select("c_custkey", _even_length(F.col("c_mktsegment")).alias("r"))
    return c.select("c_custkey", F.col("r.value").alias("value"), F.col("r.error").alias("error"))


QUERIES = {
    "null_on_error": q_null_on_error,
    "paths_frame": q_paths_frame,
    "default_label": q_default_label,
    "text_roundtrip": q_text_roundtrip,
    "scan_files": q_scan_files,
    "parquet_roundtrip": q_parquet_roundtrip,
    "global_avg": q_global_avg,
    "suffix_filter": q_suffix_filter,
    "range_square": q_range_square,
}

SQL = {
    "null_on_error": """
        SELECT c_custkey, CASE WHEN length(c_mktsegment) % 2 = 0 THEN CAST(length(c_mktsegment) AS INTEGER) END AS value,
               CASE WHEN length(c_mktsegment) % 2 = 1 THEN 'ValueError: ' || c_mktsegment END AS error FROM customer""",
    "paths_frame": "SELECT url AS pdf_path FROM pages",
    "default_label": "SELECT url AS path, url AS image, 0 AS label FROM pages",
    "text_roundtrip": "SELECT url AS value FROM pages",
    "scan_files": """SELECT regexp_extract(url, '/([a-z]{2})/', 1) AS lang, CAST(sum(strlen(html) + 1) AS BIGINT) AS n_bytes
        FROM pages GROUP BY 1""",
    "parquet_roundtrip": """SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS n,
        round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total FROM embeddings""",
    "global_avg": "SELECT round(avg(o_totalprice), 6) AS avg_totalprice, count(*) AS n FROM orders",
    "suffix_filter": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring'",
    "range_square": "SELECT o_orderkey, o_orderkey * o_orderkey AS square FROM orders",
}
