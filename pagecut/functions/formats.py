"""Formatting of times and metric values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats (values that must match the reference's output text):
#   ISO processing time     yyyy-MM-dd'T'HH:mm:ss.SSSSSS
#   run tag                 yyyyMMdd-HHmmss
#   metric                  %.4f
#   percentage              %.2f%%
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
RUN_TAG_FORMAT = "yyyyMMdd-HHmmss"


def iso_timestamp(ts: Column | None = None) -> Column:
    """ISO-8601 text of ``ts`` (default: the processing time)."""
    return F.date_format(F.current_timestamp() if ts is None else ts, ISO_FORMAT)


def run_tag(ts: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if ts is None else ts, RUN_TAG_FORMAT)


def metric_text(x: Column) -> Column:
    return F.format_string("%.4f", x)


def percent_text(x: Column) -> Column:
    return F.format_string("%.2f%%", x)
