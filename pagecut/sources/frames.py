"""Small driver-side inputs: explicit or inferred schemas, number ranges.

For configuration rows and tests only; corpus data is never collected to
the driver and re-created.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def frame(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Rows with an explicit ``StructType`` / DDL schema, or inferred from a
    list of column names."""
    return spark.createDataFrame(rows, schema)


def squares(spark: SparkSession, start: int, end: int) -> DataFrame:
    """``x * x`` for ``x`` in ``[start, end)``, generated on the executors."""
    return spark.range(start, end).select(F.col("id").alias("x"), square(F.col("id")).alias("square"))


def square(c: Column) -> Column:
    return c * c
