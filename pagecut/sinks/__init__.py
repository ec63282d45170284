"""Writers: Parquet, text, CSV, JSON records, partitioned page tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_lines(df: DataFrame, col: str, path: str, mode: str = "overwrite") -> None:
    """One value per line (e.g. predicted first-page paths)."""
    df.select(F.col(col).cast("string")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line and no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON record per row (nested structs kept)."""
    df.write.mode(mode).json(path)


def write_pages(pages: DataFrame, path: str, bundle: str, page: str,
                partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Page table clustered by bundle: range-partitioned and sorted by
    ``(bundle, page)`` so each file holds whole bundle ranges and Parquet
    min/max statistics prune bundle lookups; ``partition_by`` adds folders
    (only for a low-cardinality column)."""
    w = pages.repartitionByRange(bundle, page).sortWithinPartitions(bundle, page).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
