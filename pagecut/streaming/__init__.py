"""Structured Streaming: incremental page extraction from arriving bundles.

The reference is batch-only; this re-aims its preparation step (bundle ->
pages) at a growing folder of bundle tables.  Splitting is stateless, so the
stream is a plain ``readStream`` -> ``posexplode`` -> ``writeStream`` with a
checkpoint in the shared checkpoint folder (exactly-once file sink, restart
after executor or driver loss).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pagecut.operators.pages import text_to_pages


def page_stream(spark: SparkSession, source: str, schema, bundle: str, text: str,
                pattern: str = "*.parquet", max_files_per_trigger: int = 64) -> DataFrame:
    """Streaming DataFrame of pages from Parquet bundle files in the folder
    ``source`` whose names match ``pattern``."""
    raw = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
           .option("pathGlobFilter", pattern).parquet(source))
    return text_to_pages(raw, bundle, text)


def write_page_stream(pages: DataFrame, sink: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append pages to a Parquet table; ``once`` drains what is there and stops."""
    w = pages.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()
