"""Cut bundles into segments at first pages.

A segment starts at a first page and runs to the next first page, or to the
end of the bundle.  Pages before the first boundary belong to no segment and
a bundle without boundaries has no segment (``include_leading`` keeps them as
segment 0).  Segment ids are 1-based, so segment ``i`` is named
``segment_<i>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecut.functions.paths import segment_name
from pagecut.operators.prefix import running_sums

# Pages per bin of the range join; a page meets at most the segments that
# overlap its bin, so candidate pairs stay linear in the input.
RANGE_BIN = 256


def segment_pages(pages: DataFrame, keys: Sequence[str], order: Sequence[str],
                  is_first: Column, *, page_col: str = "page_number",
                  number: bool = True, include_leading: bool = False,
                  strategy: str = "auto") -> DataFrame:
    """Page number (if ``number``) and segment id of every page, in one pass.

    Both are running sums over the bundle's page order (``1`` and the boundary
    flag), computed by ``running_sums`` so a giant bundle is split over many
    tasks.
    """
    values = {"segment_id": F.coalesce(is_first.cast("int"), F.lit(0))}
    if number:
        values[page_col] = F.lit(1)
    out = running_sums(pages, values, order, keys, strategy=strategy)
    if number:
        out = out.withColumn(page_col, (F.col(page_col) - 1).cast("int"))
    out = out.withColumn("segment_id", F.col("segment_id").cast("int"))
    if not include_leading:
        out = out.where(F.col("segment_id") > 0)
    return out


def segment_ranges(seg_pages: DataFrame, keys: Sequence[str], page_col: str = "page_number",
                   total_pages: DataFrame | None = None, contiguous: bool = True) -> DataFrame:
    """``[start_page, end_page)`` of every segment, with ``n_pages`` and the
    bundle's ``total_pages``.

    ``end_page`` is the next segment's start, or the bundle's total pages for
    the last one.  ``seg_pages`` holds every page of the bundles (segment 0
    included).  ``contiguous`` (pages numbered ``0 .. n-1``, as
    ``segment_pages`` numbers them) makes this one aggregate per segment:
    the next start is the segment's last page + 1 and the total is a row
    count, which Catalyst computes from the scan without the window.  With
    gaps in the numbering (``contiguous=False``) the next start comes from an
    equi-join on ``(keys, segment_id + 1)`` and the total defaults to the
    highest page + 1.  No per-bundle window: a hot bundle is spread over tasks.
    """
    keys = list(keys)
    seg = (seg_pages.where(F.col("segment_id") > 0)
           .groupBy(*keys, "segment_id")
           .agg(F.min(page_col).alias("start_page"), (F.max(page_col) + 1).alias("__end"),
                F.count(F.lit(1)).alias("n_pages")))
    if total_pages is None:
        total = F.count(F.lit(1)) if contiguous else F.max(page_col) + 1
        total_pages = seg_pages.groupBy(*keys).agg(total.cast("int").alias("total_pages"))
    out = seg.join(total_pages.select(*keys, "total_pages"), on=keys, how="left")
    if contiguous:
        end = F.col("__end")
    else:
        nxt = seg.select(*keys, (F.col("segment_id") - 1).alias("segment_id"), F.col("start_page").alias("__next"))
        out = out.join(nxt, on=[*keys, "segment_id"], how="left")
        end = F.coalesce("__next", "total_pages")
    return (out.withColumn("end_page", end.cast("int"))
            .withColumn("segment_name", segment_name(F.col("segment_id")))
            .drop("__next", "__end"))


def segment_range_join(pages: DataFrame, ranges: DataFrame, keys: Sequence[str],
                       page_col: str = "page_number", bin_size: int = RANGE_BIN) -> DataFrame:
    """Pages joined to the segment whose ``[start_page, end_page)`` holds them.

    Binned range join: each range is exploded into the page bins it covers
    and joined on ``(keys, bin)``, then the exact predicate is applied.  Never
    an all-pairs join inside a bundle.
    """
    keys = list(keys)
    b = F.lit(bin_size)
    r = (ranges.select(*keys, "segment_id", "start_page", "end_page")
         .withColumn("__bin", F.explode(F.sequence(F.floor(F.col("start_page") / b),
                                                   F.floor((F.col("end_page") - 1) / b)))))
    p = pages.withColumn("__bin", F.floor(F.col(page_col) / b))
    joined = p.join(r, on=[*keys, "__bin"], how="inner") \
        .where((F.col(page_col) >= F.col("start_page")) & (F.col(page_col) < F.col("end_page")))
    return joined.drop("__bin")


def write_segments(seg_pages: DataFrame, path: str, keys: Sequence[str], page_col: str = "page_number",
                   mode: str = "overwrite", layout: str = "clustered",
                   pages_per_file: int = 100_000) -> None:
    """Write every segment so it can be read on its own.

    ``clustered`` (default): one table range-partitioned and sorted by
    ``(keys, segment_id, page)``; a segment is a contiguous run of rows that
    Parquet min/max statistics prune to, and the file count does not grow
    with the number of segments.  ``folders``: one folder per segment,
    ``<key>=../segment_id=..`` (the one-output-per-segment layout); rows are
    shuffled on ``(keys, segment_id, page block)`` so a giant segment is
    written by many tasks.  ``in_place``: rows stay where the cut left them (a bundle's
    pages in order, in one task or a few), without another shuffle; Bloom
    filters on the keys prune the read of one bundle.
    """
    order = [*keys, "segment_id", page_col]
    if layout == "clustered":
        seg_pages.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).parquet(path)
    elif layout == "in_place":
        blooms = {f"parquet.bloom.filter.enabled#{k}": "true" for k in keys}
        seg_pages.write.mode(mode).options(**blooms).parquet(path)
    elif layout == "folders":
        block = F.floor(F.col(page_col) / F.lit(pages_per_file))
        seg_pages.repartition(*keys, "segment_id", block).write.mode(mode) \
            .partitionBy(*keys, "segment_id").parquet(path)
    else:
        raise ValueError(f"unknown layout {layout!r}")


def read_segment(spark, path: str, key_values: dict, segment_id: int) -> DataFrame:
    """One segment's pages from a ``write_segments`` output (pruned read)."""
    df = spark.read.parquet(path)
    cond = F.col("segment_id") == F.lit(segment_id)
    for k, v in key_values.items():
        cond = cond & (F.col(k) == F.lit(v))
    return df.where(cond)
