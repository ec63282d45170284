"""Path and name functions for page files ``<root>/<bundle>/page_<i>.png``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    """Last component of a ``/``-separated path."""
    return F.element_at(F.split(path, "/"), -1)


def strip_extension(name: Column) -> Column:
    """Drop the **last** extension only: ``a.pdf.pdf`` -> ``a.pdf``."""
    return F.regexp_replace(name, r"\.[^./]+$", "")


def strip_all(name: Column, ext: str = ".pdf") -> Column:
    """Drop **every** occurrence of ``ext``: ``a.pdf.pdf`` -> ``a``."""
    return F.replace(name, F.lit(ext), F.lit(""))


def page_path(root: str | Column, bundle: Column, page: Column, ext: str = "png") -> Column:
    """``<root>/<bundle>/page_<page>.<ext>``."""
    root_col = F.lit(root) if isinstance(root, str) else root
    return F.concat_ws("/", root_col, bundle.cast("string"),
                       F.concat(F.lit("page_"), page.cast("string"), F.lit("." + ext)))


def page_number_from_path(path: Column) -> Column:
    """``.../page_12.png`` -> 12: text after the last ``_``, before the first ``.``;
    null for a name without a number."""
    tail = F.element_at(F.split(path, "_"), -1)
    return F.element_at(F.split(tail, r"\."), 1).try_cast("int")


def segment_name(segment_id: Column) -> Column:
    """1-based segment id -> ``segment_<id>``."""
    return F.concat(F.lit("segment_"), segment_id.cast("string"))
