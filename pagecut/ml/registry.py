"""Versions of a model with their metrics, and a pointer to the one in use.

A version is written whole before it is listed, and the pointer moves by one atomic
rename, so readers always find a complete model.  Everything lies on one
store that Hadoop reaches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecut.session import path_status

_VERSIONS = "version string, metric string, value double"


class ModelRegistry:
    """Folder ``models/<version>``, table ``metrics``, file ``CURRENT``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def publish(self, save: Callable[[str], None], metrics: dict[str, float], version: str | None = None) -> str:
        """Write one version by ``save(path)``, then list it with its metrics."""
        version = version or uuid.uuid4().hex[:12]
        if path_status(self.spark, f"{self.root}/models/{version}") is not None:
            raise FileExistsError(f"version exists: {version}")
        save(f"{self.root}/models/{version}")
        rows = [(version, name, float(value)) for name, value in metrics.items()]
        self.spark.createDataFrame(rows, _VERSIONS).coalesce(1).write.mode("append").parquet(f"{self.root}/metrics")
        return version

    def versions(self) -> DataFrame:
        """(version, metric, value) of all listed versions."""
        if path_status(self.spark, f"{self.root}/metrics") is None:
            return self.spark.createDataFrame([], _VERSIONS)
        return self.spark.read.schema(_VERSIONS).parquet(f"{self.root}/metrics")

    def best(self, metric: str, higher_is_better: bool = True) -> str:
        """The version with the best value of ``metric``; of equal ones the first by name."""
        order = F.col("value").desc() if higher_is_better else F.col("value").asc()
        top = self.versions().where((F.col("metric") == metric) & ~F.isnan("value")).orderBy(order, "version").first()
        if top is None:
            raise LookupError(f"no version has the metric {metric}")
        return top["version"]

    def promote(self, version: str) -> None:
        """Make a version the current one, in one rename."""
        if path_status(self.spark, f"{self.root}/models/{version}") is None:
            raise FileNotFoundError(f"no such version: {version}")
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        made = path(f"{self.root}/.CURRENT.{uuid.uuid4().hex}")
        out = made.getFileSystem(conf).create(made)
        out.write(bytearray(version.encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.getFileSystem(conf).makeQualified(made).toUri(), conf)
        how = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        files.rename(made.getFileSystem(conf).makeQualified(made), made.getFileSystem(conf).makeQualified(path(f"{self.root}/CURRENT")), how)

    def current(self) -> str | None:
        """The version in use."""
        if path_status(self.spark, f"{self.root}/CURRENT") is None:
            return None
        return self.spark.read.text(f"{self.root}/CURRENT", wholetext=True).first()["value"].strip()

    def path(self, version: str | None = None) -> str:
        """Where a version (the current one) lies."""
        version = version or self.current()
        if version is None:
            raise LookupError("no version has been promoted")
        return f"{self.root}/models/{version}"
