"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecut.session import checkpoint_root, scratch_path

#: A word is a run of anything but these six ASCII blanks.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage: later passes read the table, and a lost executor costs
    no recomputation of what came before it.  The schema is passed to the
    reader, so an empty table comes back empty with its columns.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame) -> DataFrame:
    """(_doc struct of all columns, _key) for every row of ``docs``; the key names the row in every later scan.

    The key is the row's file (as a digest) and its place there, so it does
    not depend on how a scan is cut into tasks.  Rows that don't come straight
    from files are stored first.
    """
    def with_key(rows):
        key = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        return rows.select(F.struct(*rows.columns).alias("_doc"), key.alias("_key"))

    try:
        return with_key(docs)
    except AnalysisException:  # no file behind the rows
        return with_key(store(docs, "rows"))


def chosen(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents of ``keyed`` rows whose key is in the column ``_key`` of ``keys``."""
    return rows.join(keys.hint("shuffle_hash"), "_key", "left_semi").select("_doc.*")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
