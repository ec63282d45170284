"""One file for each row (page images, bundles) on any store, through a data source with commit and abort."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from pagecut.sources.stores import Store, resolved

#: Marks a finished folder: files and bytes written, then the lists of the tasks that count.
DONE, LISTS = "_SUCCESS", "_lists"


@dataclass
class Written(WriterCommitMessage):
    files: int
    bytes: int
    list: str


class _Writer(DataSourceArrowWriter):
    """Each file is written whole under its own name, so a task that runs again changes nothing."""

    def __init__(self, root: str):
        self.root = root

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, rows, size = Store(self.root), [], 0
        for batch in iterator:
            for name, content in zip(batch.column(0), batch.column(1)):
                data = content.as_py()
                if not name.is_valid or data is None:
                    continue
                store.put(name.as_py(), data)
                rows.append(json.dumps({"name": name.as_py(), "length": len(data)}))
                size += len(data)
        # every attempt lists its files under a name of its own; the commit says which lists count
        listed = f"{LISTS}/{uuid.uuid4().hex}.json"
        if rows:
            store.put(listed, ("\n".join(rows) + "\n").encode())
        return Written(len(rows), size, listed if rows else "")

    def commit(self, messages: list[Written]) -> None:
        done = [m for m in messages if m is not None]
        lines = [f"{sum(m.files for m in done)} {sum(m.bytes for m in done)}", *(m.list for m in done if m.list)]
        Store(self.root).put(DONE, ("\n".join(lines) + "\n").encode())

    def abort(self, messages: list[Written]) -> None:
        """The folder stays without its mark; the same write can be run again over it."""
        Store(self.root).drop(DONE)


class PageFiles(DataSource):
    """Sink ``pagecut_files``: columns (name, content), option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "pagecut_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def _local(root: str) -> str:
    """The local path behind ``root``; a ValueError for any other store."""
    if "://" in root and not root.startswith("file://"):
        raise ValueError(f"not a local path: {root}")
    return "/" + root[len("file:"):].lstrip("/") if root.startswith("file:") else root


def write_binary_files(df: DataFrame, name_col: str, content_col: str, root: str) -> None:
    """Write ``content`` to ``<root>/<name>``, one file for each row, then ``_SUCCESS`` with their number.

    Names must be unique; rows with a null name or content write nothing.  ``root`` may be
    on any store that Hadoop resolves to one that Arrow writes.  If a task fails for good, the
    folder has no ``_SUCCESS``.
    """
    df.sparkSession.dataSource.register(PageFiles)
    files = df.select(F.col(name_col).cast("string").alias("name"), F.col(content_col).cast("binary").alias("content"))
    files.write.format(PageFiles.name()).mode("append").save(resolved(df.sparkSession, root, make=True))


def _commit(root: str) -> list[str] | None:
    store = Store(root)
    try:
        with store.open(f"{store.root}/{DONE}") as file:
            return file.read().decode().split("\n")[:-1]
    except FileNotFoundError:
        return None


def finished(root: str) -> tuple[int, int] | None:
    """(files, bytes) that the write of a resolved folder reported; None if it isn't finished."""
    lines = _commit(root)
    return tuple(map(int, lines[0].split())) if lines else None


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(name, length) of the files that the last finished write to ``path`` committed, from its own lists."""
    lines = _commit(resolved(spark, path))
    if lines is None:
        raise FileNotFoundError(f"no finished write at {path}")
    schema = "name string, length bigint"
    if not lines[1:]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json([f"{path.rstrip('/')}/{name}" for name in lines[1:]])
