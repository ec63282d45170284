"""Reproducible splits and class balancing.

``randomSplit`` and unseeded ``sample`` depend on how rows are partitioned,
so a retried or re-partitioned job can put a row on the other side.  Here
every decision is a function of the row id and a seed (an md5 bucket), so
splits are stable under retries, repartitioning and engine changes.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecut.operators.prefix import running_sums

# Copies generated per row at most, per generator call.
COPY_BLOCK = 4096


def hash32(id_col: Column, seed: int | str = 42, salt: str = "") -> Column:
    """First 32 bits of ``md5("<id>:<seed><salt>")`` as a non-negative bigint."""
    key = F.concat(id_col.cast("string"), F.lit(f":{seed}{salt}"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def hash_bucket(id_col: Column, seed: int | str = 42, buckets: int = 100) -> Column:
    return hash32(id_col, seed) % F.lit(buckets)


def split_hash(df: DataFrame, id_col: str, test_percent: int = 20, seed: int = 42,
               name: str = "split") -> DataFrame:
    """``test`` when the id's bucket (0..99) is below ``test_percent``."""
    return df.withColumn(name, F.when(hash_bucket(F.col(id_col), seed) < test_percent, F.lit("test"))
                         .otherwise(F.lit("train")))


def split_exact(df: DataFrame, id_col: str, test_fraction: float = 0.2, seed: int = 42,
                name: str = "split", strata: str | None = None, strategy: str = "auto") -> DataFrame:
    """Exactly ``ceil(n * test_fraction)`` rows to ``test`` (per stratum, null
    included, when ``strata`` is given): rows ranked by ``(hash, id)``; rank from
    ``running_sums``, so the global ordering is not a single-task window."""
    keyed = df.withColumn("__h", hash32(F.col(id_col), seed))
    keys = [strata] if strata else []
    ranked = running_sums(keyed, {"__rank": F.lit(1)}, ["__h", id_col], keys, strategy=strategy)
    # ceil(n * fraction) in integers, the fraction read as written: no float rounding at exact multiples
    part = Fraction(str(test_fraction))
    num, den = part.numerator, part.denominator
    if strata:
        sizes = df.groupBy(F.col(strata).alias("__s")).agg(F.count(F.lit(1)).alias("__n"))
        ranked = ranked.join(sizes, F.col(strata).eqNullSafe(F.col("__s")), "left")
        cut = F.floor((F.col("__n").cast("decimal(38,0)") * num + (den - 1)) / F.lit(den))
    else:
        cut = F.lit((df.count() * num + den - 1) // den)
    out = ranked.withColumn(name, F.when(F.col("__rank") <= cut, F.lit("test")).otherwise(F.lit("train")))
    return out.drop("__h", "__rank", "__n", "__s")


def split_stratified(df: DataFrame, id_col: str, label: str, test_fraction: float = 0.2,
                     seed: int = 42, name: str = "split", strategy: str = "auto") -> DataFrame:
    return split_exact(df, id_col, test_fraction, seed, name, strata=label, strategy=strategy)


def class_counts(df: DataFrame, label: str, minority=1) -> tuple[int, int]:
    row = df.agg(F.sum((F.col(label) != minority).cast("long")).alias("n0"),
                 F.sum((F.col(label) == minority).cast("long")).alias("n1")).first()
    return int(row["n0"] or 0), int(row["n1"] or 0)


def oversample_minority(df: DataFrame, label: str, id_col: str, minority=1, seed: int = 42,
                        copy_col: str = "copy") -> DataFrame:
    """Grow the minority class to about the majority's size, deterministically.

    Each minority row is repeated ``floor(n0/n1)`` times, plus once more when
    its hash fraction falls under the remainder; majority rows are kept once
    (``copy = 0``).  Raises before running a job when there is no minority row.
    """
    n0, n1 = class_counts(df, label, minority)
    if n1 == 0:
        raise ValueError("cannot oversample: the minority class has no rows")
    ratio = n0 / n1
    whole = math.floor(ratio)
    rem = ratio - whole
    frac = hash32(F.col(id_col), seed, ":os").cast("double") / F.lit(4294967296.0)
    copies = F.lit(whole) + F.when(frac < F.lit(rem), 1).otherwise(0)
    is_minor = F.col(label).eqNullSafe(F.lit(minority))
    # minority copies come in blocks, dealt over tasks before they are expanded; majority rows stay where they are
    b = F.lit(COPY_BLOCK)
    major = df.where(~is_minor).withColumn(copy_col, F.lit(0))
    blocks = df.where(is_minor).withColumn("__n", copies).withColumn(
        "__b", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / b).cast("int"))))
    blocks = blocks.where(F.col("__n") > 0).repartition(F.col(id_col), F.col("__b"))
    minor = blocks.withColumn(copy_col, F.explode(F.sequence(
        (F.col("__b") * b).cast("int"), (F.least(F.col("__n"), (F.col("__b") + 1) * b) - 1).cast("int"))))
    return major.unionByName(minor.drop("__n", "__b"))


def fold_column(id_col: Column, k: int = 3, seed: int = 42) -> Column:
    """Deterministic fold id ``0 .. k-1`` for cross-validation (int)."""
    return (hash32(id_col, seed, ":fold") % F.lit(k)).cast("int")
