"""Ordered running sums that stay parallel when one group is huge.

A window ``partitionBy(bundle).orderBy(page)`` puts every row of a bundle in
one task; if one bundle holds a third of all rows, one task sorts a third of
the data.  A window without ``partitionBy`` (ROC curves, exact splits) runs in
a single task by construction.

``running_sums`` avoids both.  The ``chunked`` strategy:

1. range-partitions the rows on ``(keys, order)`` into ``n`` chunks and tags
   each row with its chunk id; the result is checkpointed into the shared
   checkpoint folder, which freezes the chunk boundaries (the range sampler
   is not repeatable across jobs) and cuts lineage;
2. computes local running sums with a window over ``(keys, chunk)``: no group
   is larger than one chunk;
3. summarises each chunk by the totals of its first and last key (at most two
   rows per chunk) with two small aggregates;
4. turns the summary into the carry-in of every chunk's first key (a window
   over at most ``2 n`` rows) and adds it back through a join, broadcast while
   ``2 n`` is at most ``BROADCAST_ROWS``.

The ``window`` strategy is the plain window (one shuffle on the keys).
``auto`` measures group sizes with one aggregate over the key columns; groups
above ``hot_rows`` go through the chunked path and all other groups through
the plain window, and the two results are unioned.  The hot-key list used to
split the input has at most ``total_rows / hot_rows`` entries; it is
broadcast while that bound is at most ``BROADCAST_ROWS``.  The number of chunks grows with the rows that
take the chunked path (``rows_per_chunk``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Groups above this many rows are treated as hot by the ``auto`` strategy.
DEFAULT_HOT_ROWS = 2_000_000
# Target rows per chunk of the chunked strategy.
DEFAULT_ROWS_PER_CHUNK = 4_000_000
# A key list or carry table is broadcast up to this many rows; beyond, Catalyst plans the join.
BROADCAST_ROWS = 200_000


def _names(cols: Sequence[str | Column]) -> list[str]:
    out = []
    for c in cols:
        if not isinstance(c, str):
            raise TypeError("running_sums takes column names; add computed columns first")
        out.append(c)
    return out


def running_sums(df: DataFrame, values: dict[str, Column], order: Sequence[str],
                 keys: Sequence[str] = (), *, strategy: str = "auto",
                 num_chunks: int | None = None, hot_rows: int = DEFAULT_HOT_ROWS,
                 rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK, max_rows: int | None = None) -> DataFrame:
    """Add one inclusive running-sum column per ``values`` entry.

    Rows are ordered by ``order`` within each ``keys`` group (all rows form
    one group when ``keys`` is empty).  Ties in ``order`` are summed in an
    unspecified order, as with a window; give a unique order for exact
    numbering.  Value expressions must be integral or exact for results to be
    independent of the strategy.  ``max_rows``, an upper bound on the input
    rows known to the caller, lets ``auto`` skip its measuring job when no
    group can be hot.
    """
    keys = _names(keys)
    order = _names(order)
    if strategy not in ("auto", "window", "chunked"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "window":
        return _window(df, values, order, keys)
    if strategy == "chunked":
        return _chunked(df, values, order, keys, num_chunks)
    # auto: measure, then route hot groups to the chunked path
    if max_rows is not None and max_rows <= hot_rows:
        return _window(df, values, order, keys)
    if not keys:
        total = df.count()
        if total <= hot_rows:
            return _window(df, values, order, keys)
        n = num_chunks or _chunks_for(df, total, rows_per_chunk)
        return _chunked(df, values, order, keys, n)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    stats = sizes.agg(F.max("__n").alias("m"), F.sum(F.when(F.col("__n") > hot_rows, F.col("__n")))
                      .alias("hot")).first()
    if (stats["m"] or 0) <= hot_rows:
        return _window(df, values, order, keys)
    hot_keys = sizes.where(F.col("__n") > hot_rows).select(*keys)
    hot_keys = _small(hot_keys, int(stats["hot"]) // hot_rows)  # each stands for over hot_rows rows
    cond = [df[k].eqNullSafe(hot_keys[k]) for k in keys]
    hot = df.join(hot_keys, on=cond, how="left_semi")
    cold = df.join(hot_keys, on=cond, how="left_anti")
    n = num_chunks or _chunks_for(df, int(stats["hot"]), rows_per_chunk)
    out_hot = _chunked(hot, values, order, keys, n)
    out_cold = _window(cold, values, order, keys)
    return out_cold.unionByName(out_hot.select(*out_cold.columns))


def _small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its proven bound allows it."""
    return F.broadcast(df) if max_rows <= BROADCAST_ROWS else df


def _chunks_for(df: DataFrame, rows: int, rows_per_chunk: int) -> int:
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(base, -(-rows // rows_per_chunk))


def _window(df: DataFrame, values: dict[str, Column], order: list[str], keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df
    for name, expr in values.items():
        out = out.withColumn(name, F.sum(expr).over(w))
    return out


def _chunked(df: DataFrame, values: dict[str, Column], order: list[str],
             keys: list[str], num_chunks: int | None) -> DataFrame:
    from pagecut.session import checkpoint_root

    spark = df.sparkSession
    checkpoint_root(spark)
    n = num_chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tmp = {name: f"__v_{i}" for i, name in enumerate(values)}
    base = df
    for name, expr in values.items():
        base = base.withColumn(tmp[name], _widen(base.select(expr).schema[0].dataType, expr))
    # 1. chunks: contiguous ranges of (keys, order); frozen by a reliable checkpoint
    ranged = (base.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in keys + order])
              .withColumn("__chunk", F.spark_partition_id())
              .sortWithinPartitions(*keys, *order)
              .checkpoint(eager=True))

    # 2. local sums inside (keys, chunk): groups never exceed a chunk
    w = Window.partitionBy(*keys, "__chunk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = ranged
    for name in values:
        local = local.withColumn(tmp[name], F.sum(tmp[name]).over(w))

    # 3. per-chunk edge totals: first and last key of each chunk.  Totals per
    #    (chunk, key) are small (the chunked path only sees hot keys, or no
    #    key); min/max of struct(keys, sums) picks the first and last key.
    vcols = [tmp[name] for name in values]
    val_types = {c: ranged.schema[c].dataType for c in vcols}
    tot = ranged.groupBy("__chunk", *keys).agg(*[F.sum(c).alias(c) for c in vcols])
    if keys:
        st = F.struct(*[F.col(k) for k in keys], *[F.col(c) for c in vcols])
        e = tot.groupBy("__chunk").agg(F.min(st).alias("__lo"), F.max(st).alias("__hi"))
        first = e.select("__chunk", F.lit(True).alias("__first"), "__lo.*")
        last = e.where(~F.col("__lo").eqNullSafe(F.col("__hi"))) \
            .select("__chunk", F.lit(False).alias("__first"), "__hi.*")
        summary = first.unionByName(last)
    else:
        summary = tot.select("__chunk", F.lit(True).alias("__first"), *vcols)

    # 4. carry-in of each chunk's first key = totals of the same key in earlier
    #    chunks.  ``summary`` has at most 2 rows per chunk.
    if keys:
        wk = Window.partitionBy(*keys).orderBy("__chunk", F.col("__first").desc()).rowsBetween(
            Window.unboundedPreceding, -1)
    else:
        wk = Window.orderBy("__chunk", F.col("__first").desc()).rowsBetween(
            Window.unboundedPreceding, -1)
    carry = summary
    for c in vcols:
        carry = carry.withColumn("__c" + c, F.coalesce(F.sum(c).over(wk), F.lit(0).cast(val_types[c])))
    carry = carry.where("__first").select("__chunk", *keys, *["__c" + c for c in vcols])

    carry = carry.select(*[F.col(c).alias("__k" + c) for c in ["__chunk", *keys]],
                         *["__c" + c for c in vcols])
    cond = [local[c].eqNullSafe(carry["__k" + c]) for c in ["__chunk", *keys]]
    joined = local.join(_small(carry, 2 * n), on=cond, how="left")
    out = joined.drop(*["__k" + c for c in ["__chunk", *keys]])
    for name in values:
        c = tmp[name]
        out = out.withColumn(name, F.col(c) + F.coalesce(F.col("__c" + c), F.lit(0).cast(val_types[c])))
    return out.drop("__chunk", *vcols, *["__c" + c for c in vcols])


def _widen(dtype: T.DataType, expr: Column) -> Column:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return expr.cast("bigint")
    if isinstance(dtype, T.DecimalType):
        return expr
    return expr.cast("double")


