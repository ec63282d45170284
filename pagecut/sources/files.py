"""File listings, page images and binary bundles."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_files(spark: SparkSession, path: str, pattern: str = "*.pdf", recursive: bool = False,
               with_content: bool = False) -> DataFrame:
    """Files under ``path`` whose name matches ``pattern`` (case-sensitive glob).

    ``binaryFile`` only reads file bodies when ``content`` is selected, so a
    listing is metadata only.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
          .option("recursiveFileLookup", str(recursive).lower()).load(path))
    cols = ["path", "modificationTime", "length"] + (["content"] if with_content else [])
    return df.select(*cols)


def paths_frame(df: DataFrame, path: str = "path", name: str = "pdf_path") -> DataFrame:
    """One-column frame of paths (the listing, renamed)."""
    return df.select(F.col(path).alias(name))


def read_images(spark: SparkSession, path: str, drop_invalid: bool = False,
                recursive: bool = True) -> DataFrame:
    """Spark's ``image`` source: PNG/JPEG decoded in the JVM.  An undecodable
    file is a row with ``height = -1`` (or dropped with ``drop_invalid``)."""
    return (spark.read.format("image").option("dropInvalid", str(drop_invalid).lower())
            .option("recursiveFileLookup", str(recursive).lower()).load(path))


#: Scan partitions (32 small files or 128 MB each) that one task reads when there are many.
_PARTS = 32


def few_tasks(files: DataFrame) -> DataFrame:
    """A scan of files in fewer tasks: Spark puts no more than 32 files into a partition, however small they are."""
    parts = files.rdd.getNumPartitions()  # plans the scan, runs nothing
    return files.coalesce(max(1, min(parts, max(4 * files.sparkSession.sparkContext.defaultParallelism, parts // _PARTS))))


PAGE_SCHEMA = T.StructType([
    T.StructField("pdf_name", T.StringType()),
    T.StructField("page_number", T.IntegerType()),
    T.StructField("content", T.BinaryType()),
])


def binary_to_pages(files: DataFrame, splitter: Callable[[bytes], list[bytes]],
                    name: Column | None = None, report_errors: bool = False) -> DataFrame:
    """Split binary bundles into pages with a pluggable ``splitter``.

    ``splitter(content) -> [page bytes]`` runs in ``mapInPandas``; a bundle
    that cannot be opened gives no page (never a failed task).  Pages are
    numbered from 0.  With ``report_errors`` such a bundle gives a row without page
    number and content, and the column ``error`` says why.
    """
    from pagecut.functions.paths import basename, strip_extension

    name = name if name is not None else strip_extension(basename(F.col("path")))
    src = files.select(name.alias("pdf_name"), "content")

    def run(batches):
        for pdf in batches:
            for bundle, content in zip(pdf["pdf_name"], pdf["content"]):
                try:
                    pages, error = splitter(bytes(content)) if content is not None else [], None
                except Exception as exc:  # noqa: BLE001 - any failure of the splitter is the bundle's
                    pages, error = [], f"{type(exc).__name__}: {exc}"
                rows = [(bundle, i, p, None) for i, p in enumerate(pages)]
                if error and report_errors:
                    rows = [(bundle, None, None, error)]
                out = pd.DataFrame(rows, columns=schema.names)
                out["page_number"] = out["page_number"].astype("Int32")
                yield out

    schema = T.StructType([*PAGE_SCHEMA, T.StructField("error", T.StringType())])
    found = src.mapInPandas(run, schema)
    return found if report_errors else found.drop("error")
