"""UDF surfaces: table functions, SQL-registered functions, error capture."""

from __future__ import annotations

import functools
import io
import zipfile
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udtf


@arrow_udtf(returnType="id: bigint, page_number: int, page_text: string")
class SplitPages:
    """Arrow UDTF over a table (id, text): one row per page (0-based), whole batches in and out.

    ``SplitPages(df.asTable())`` for a table of an id and a text; from SQL
    ``split_pages(TABLE(t))`` once registered.  A null text has no page.  The
    native ``text_to_pages`` (posexplode) is faster; this is the table-UDF
    surface for splitters that Spark lacks.
    """

    def eval(self, batch: pa.RecordBatch):
        pages = pc.split_pattern(batch.column(1), "\n")
        size = pc.fill_null(pc.list_value_length(pages), 0).to_numpy()
        begin = np.repeat(np.cumsum(size) - size, size)
        yield pa.table({"id": batch.column(0).take(pa.array(np.repeat(np.arange(len(size)), size))),
                        "page_number": pa.array(np.arange(len(begin)) - begin, pa.int32()), "page_text": pages.flatten()})


def register_is_first_page(spark: SparkSession, page_labels: DataFrame,
                           name: str = "is_first_page", view: str = "pagecut_page_labels") -> None:
    """SQL function ``is_first_page(bundle, page) -> int`` (1 or default 0).

    ``page_labels`` has columns ``bundle, page_number, label``.  The function
    is a SQL UDF over a temp view, so Catalyst decorrelates each call into a
    join: no label dictionary on the driver, no Python per row.
    """
    page_labels.select("bundle", "page_number", "label").createOrReplaceTempView(view)
    btype = page_labels.schema["bundle"].dataType.simpleString()
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(b {btype}, p INT) RETURNS INT "
        f"RETURN coalesce((SELECT max(l.label) FROM {view} l "
        f"WHERE l.bundle = b AND l.page_number = p), 0)")


def zip_udf():
    """Arrow UDF: an array of page texts -> an archive with one member ``page_<i>`` for each; null stays null."""
    @F.arrow_udf(T.BinaryType())
    def pack(pages: pa.Array) -> pa.Array:
        out = []
        for value in pages:
            if not value.is_valid:
                out.append(None)
                continue
            file = io.BytesIO()
            with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
                for i, page in enumerate(value.as_py()):
                    archive.writestr(zipfile.ZipInfo(f"page_{i}"), page or "", zipfile.ZIP_DEFLATED)
            out.append(file.getvalue())
        return pa.array(out, pa.binary())
    return pack


def null_on_error(return_type: T.DataType | str) -> Callable:
    """Decorator: a per-value function becomes a pandas UDF returning
    ``struct<value, error>``; an exception yields a null value and its message."""
    rt = T._parse_datatype_string(return_type) if isinstance(return_type, str) else return_type
    schema = T.StructType([T.StructField("value", rt), T.StructField("error", T.StringType())])

    def wrap(fn: Callable) -> Callable:
        @F.pandas_udf(schema)
        @functools.wraps(fn)
        def run(col: pd.Series) -> pd.DataFrame:
            values, errors = [], []
            for v in col:
                try:
                    values.append(fn(v))
                    errors.append(None)
                except Exception as exc:  # noqa: BLE001 - the point is to capture it
                    values.append(None)
                    errors.append(f"{type(exc).__name__}: {exc}")
            return pd.DataFrame({"value": values, "error": errors})
        return run
    return wrap
