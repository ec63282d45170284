"""Parquet tables of a corpus directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``<root>/<name>.parquet``; filters and projections push into the scan."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")

