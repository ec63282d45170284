"""Binary bundles as a data source: a row for each page, a partition for each range of pages.

``read_bundles`` lists the bundle files of a folder, packs small ones together
and cuts large ones into ranges of pages, so neither many bundles nor one giant one
decides the number of tasks.  A format says how a bundle opens and how one of its pages is
read; ``ZipPages`` reads archives, whose directory gives any page without the others.
A bundle that doesn't open is a row with its error.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import IO, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pagecut.sources.stores import Store, resolved

SCHEMA = "path string, pdf_name string, page_number int, content binary, error string"
#: Bytes of pages that are handed on together.
BATCH_BYTES = 4 << 20


class BundleFormat(Protocol):
    """How the pages of one bundle file are reached."""

    def open(self, file: IO[bytes]) -> object:
        """The opened bundle; raises if it isn't one."""

    def count(self, bundle: object) -> int:
        """Number of its pages."""

    def read(self, bundle: object, page: int) -> bytes:
        """One page, numbered from 0."""


class ZipPages:
    """Archives with one member for each page, in the order of the numbers in their names."""

    def open(self, file: IO[bytes]):
        archive = zipfile.ZipFile(file)
        names = [i for i in archive.namelist() if not i.endswith("/")]
        number = lambda name: [int(d) for d in re.findall(r"\d+", name)]
        return archive, sorted(names, key=lambda name: (number(name), name))

    def count(self, bundle) -> int:
        return len(bundle[1])

    def read(self, bundle, page: int) -> bytes:
        archive, names = bundle
        return archive.read(names[page])


class WholeFile:
    """Any format that a function ``bytes -> [page bytes]`` splits."""

    def __init__(self, splitter):
        self.splitter = splitter

    def open(self, file: IO[bytes]):
        return list(self.splitter(file.read()))

    def count(self, bundle) -> int:
        return len(bundle)

    def read(self, bundle, page: int) -> bytes:
        return bundle[page]


@dataclass
class PageRange(InputPartition):
    """Bundles of one task: (path, this part, parts of the bundle)."""
    bundles: list[tuple[str, int, int]]


def plan_ranges(files: list[tuple[str, int]], target_bytes: int) -> list[PageRange]:
    """Small bundles together up to ``target_bytes``, larger ones cut into as many parts as needed."""
    ranges, held, size = [], [], 0
    for path, n_bytes in sorted(files):
        parts = -(-n_bytes // target_bytes) if n_bytes > target_bytes else 1
        if parts > 1:
            ranges += [PageRange([(path, i, parts)]) for i in range(parts)]
            continue
        if held and size + n_bytes > target_bytes:
            ranges.append(PageRange(held))
            held, size = [], 0
        held.append((path, 0, 1))
        size += n_bytes
    return ranges + ([PageRange(held)] if held else [])


class _Reader(DataSourceReader):
    def __init__(self, options: dict, form: BundleFormat):
        self.root, self.suffix, self.form = options["path"], options.get("suffix", ".zip"), form
        self.target, self.error_rows = int(options["target_bytes"]), options["error_rows"] == "true"

    def partitions(self) -> list[PageRange]:
        store = Store(self.root)
        return plan_ranges([(path, size) for path, size in store.files() if path.endswith(self.suffix)], self.target) or [PageRange([])]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        store, rows, size = Store(self.root), [], 0
        for path, part, parts in partition.bundles:
            name = path.rsplit("/", 1)[-1].removesuffix(self.suffix)
            file = store.open(path)  # a store that fails fails the task, which is tried again
            try:
                with file:
                    bundle = self.form.open(file)
                    n = self.form.count(bundle)
                    for page in range(n * part // parts, n * (part + 1) // parts):
                        content = self.form.read(bundle, page)
                        rows.append((path, name, page, content, None))
                        size += len(content)
                        if size >= BATCH_BYTES:
                            yield _batch(rows)
                            rows, size = [], 0
            except Exception as e:  # noqa: BLE001 - whatever a format raises over a bad bundle
                if self.error_rows and part == 0:
                    rows.append((path, name, None, None, f"{type(e).__name__}: {e}"))
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.string(), pa.string(), pa.int32(), pa.binary(), pa.string()
    names = ["path", "pdf_name", "page_number", "content", "error"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def bundle_source(form: BundleFormat, name: str = "pagecut_bundles") -> type[DataSource]:
    """A data source class for one format, to be registered under ``name``."""
    class Bundles(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return _Reader(dict(self.options), form)

    return Bundles


def read_bundles(spark: SparkSession, path: str, form: BundleFormat | None = None, suffix: str = ".zip",
                 target_bytes: int = 128 << 20, report_errors: bool = False) -> DataFrame:
    """(path, pdf_name, page_number, content, error) of the bundles below ``path`` that end in ``suffix``.

    Pages are numbered from 0 in the order of the bundle.  A bundle that doesn't open gives
    no page and, with ``report_errors``, a row without number and content that says why;
    a page that can't be read ends its bundle's range with such a row.
    ``path`` may be on any store that Hadoop resolves to one that Arrow reads.
    """
    source = bundle_source(form or ZipPages())
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(suffix=suffix, target_bytes=target_bytes, error_rows=str(report_errors).lower()) \
        .load(resolved(spark, path))
