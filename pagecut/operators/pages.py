"""Bundles to pages, page numbering and page-table summaries."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecut.operators.prefix import running_sums


def text_to_pages(df: DataFrame, bundle: str, text: str, sep: str = "\n",
                  page_col: str = "page_number", out_col: str = "page_text",
                  keep: Sequence[str] = ()) -> DataFrame:
    """One row per page of a text bundle; ``sep`` (literal text) ends a page.

    Page numbers are 0-based.  ``posexplode`` runs inside the scan stage:
    no shuffle, and a huge bundle is split by the generator row by row, never
    gathered.  A null text yields no page, an empty one yields one empty page.
    """
    return df.select(F.col(bundle), *keep, F.posexplode(F.split(F.col(text), re.escape(sep))).alias(page_col, out_col)) \
        .withColumn(page_col, F.col(page_col).cast("int"))


def number_pages(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 page_col: str = "page_number", strategy: str = "auto") -> DataFrame:
    """0-based position of each row in its bundle, ordered by ``order``."""
    out = running_sums(df, {page_col: F.lit(1)}, order, keys, strategy=strategy)
    return out.withColumn(page_col, (F.col(page_col) - 1).cast("int"))


def pages_per_bundle(pages: DataFrame, bundle: str, name: str = "count") -> DataFrame:
    """``groupBy(bundle).count()`` (map-side partial counts, skew-safe)."""
    return pages.groupBy(bundle).agg(F.count(F.lit(1)).alias(name))


def bundles_present(pages: DataFrame, bundle: str) -> DataFrame:
    """Bundles that have at least one page."""
    return pages.select(bundle).distinct()


def drop_null_features(pages: DataFrame, features: str = "features") -> DataFrame:
    """Training keeps only pages whose features could be computed."""
    return pages.where(F.col(features).isNotNull())


def text_page_features(text: Column, min_chars: int = 20) -> Column:
    """Feature array of a text page; null for a page too short to use.

    Features: characters, letters, digits, spaces, upper-case letters and
    punctuation, as floats.  The null rule mirrors an undecodable image.
    """
    def count(pattern: str) -> Column:
        return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("float")
    feats = F.array(F.length(text).cast("float"), count(r"\p{L}"), count(r"\p{Nd}"),
                    count(r"\s"), count(r"\p{Lu}"), count(r"\p{P}"))
    return F.when(F.length(text) >= min_chars, feats)
