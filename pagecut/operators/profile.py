"""Column profile: count, nulls, mean, stddev, min, exact quartiles, max."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecut.operators.prefix import running_sums
from pagecut.session import materialize


def column_percentiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                       strategy: str = "auto") -> dict[str, list]:
    """Exact percentiles of several columns, linearly interpolated (as SQL ``percentile``).

    Distributed and shared by all columns: one scan counts the rows of each
    ``(column, value)``, running counts by value come from ``running_sums``, and
    one aggregate picks the values at the needed ranks.  Only one row per column
    reaches the driver; a column without values gives nulls.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("col"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])
    vals = df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("v").isNotNull()) \
        .groupBy("col", "v").agg(F.count(F.lit(1)).alias("c"))
    vals = materialize(vals, "values")
    totals = {r["col"]: r["n"] for r in vals.groupBy("col").agg(F.sum("c").alias("n")).collect()}
    cum = running_sums(vals, {"cum": F.col("c")}, ["v"], ["col"], strategy=strategy)
    picks, ranks = [], {}
    for i, n in totals.items():
        for k, p in enumerate(probs):
            pos = p * (n - 1)
            lo, hi = math.floor(pos), math.ceil(pos)
            ranks[i, k] = pos, lo, hi
            here = F.col("col") == i
            picks += [F.min(F.when(here & (F.col("cum") > lo), F.col("v"))).alias(f"lo_{i}_{k}"),
                      F.min(F.when(here & (F.col("cum") > hi), F.col("v"))).alias(f"hi_{i}_{k}")]
    row = cum.agg(*picks).first() if picks else {}

    def at(i: int, k: int):
        if i not in totals:
            return None
        (pos, lo, hi), a, b = ranks[i, k], row[f"lo_{i}_{k}"], row[f"hi_{i}_{k}"]
        return a if hi == lo else a + (pos - lo) * (b - a)

    return {c: [at(i, k) for k in range(len(probs))] for i, c in enumerate(cols)}


def exact_percentiles(df: DataFrame, col: str, probs: Sequence[float], strategy: str = "auto") -> list:
    """``column_percentiles`` of one column."""
    return column_percentiles(df, [col], probs, strategy)[col]


def quality_profile(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column: ``column, count, null_count, mean, stddev, min,
    p25, p50, p75, max`` (exact quartiles; ``summary()`` gives approximate
    ones).  Two scans: the moments of all columns, and the counts per value."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.sum(F.col(c).isNull().cast("long")).alias(f"{c}__nulls"),
                 F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    m = df.agg(*aggs).first()
    quartiles = column_percentiles(df, cols, probs)
    rows = []
    for c in cols:
        rows.append((c, int(m[f"{c}__n"]), int(m[f"{c}__nulls"] or 0), m[f"{c}__mean"], m[f"{c}__std"],
                     m[f"{c}__min"], *quartiles[c], m[f"{c}__max"]))
    names = ["p" + str(int(round(p * 100))) for p in probs]
    schema = ("col_name string, count bigint, null_count bigint, mean double, stddev double, min double, "
              + ", ".join(f"{n} double" for n in names) + ", max double")
    return df.sparkSession.createDataFrame(rows, schema)
