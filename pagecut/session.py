"""Session factory and scratch locations.

``get_spark`` reuses the active session when there is one and never stops
it.  Scratch data (checkpoints, round-trip writes) always goes under the
shared folder named by ``spark.checkpoint.dir``; a private folder is only
created when the setting is absent (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults chosen for scale: AQE re-plans joins and coalesces small shuffle
# partitions at run time; skew-join splits oversized partitions; Arrow keeps
# Python UDF traffic batched.  Small Arrow batches because a page feature row
# can hold 50,176 floats.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # checkpoints of the chunked running sums are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app_name: str = "pagecut", master: str | None = None,
              memory: str | None = None, conf: dict | None = None) -> SparkSession:
    """Return the active session, or build one with ``DEFAULT_CONF``."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if memory:
        settings["spark.driver.memory"] = memory
        settings["spark.executor.memory"] = memory
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 << 20,
                           minimum: int = 200) -> int:
    """Initial shuffle partition count for an input size: about
    ``target_bytes`` per partition (AQE coalesces what turns out smaller)."""
    return max(minimum, -(-input_bytes // target_bytes))


def checkpoint_root(spark: SparkSession) -> str:
    """Shared scratch root: the cluster's ``spark.checkpoint.dir``.

    Only when nothing is configured and the master is local (a test) a private
    folder is created and registered as the checkpoint directory; on a cluster a
    machine-local folder would be lost with its machine, so that is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc._conf.get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="pagecut-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared scratch root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/pagecut-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared scratch folder and read
    it back: later passes read the table instead of recomputing the lineage
    (image decoding, joins), and a lost executor cannot force a recompute."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_counted(df, name: str, **totals):
    """``materialize`` and aggregates of the written rows: (table, {name: value}).

    Not by ``Observation``: a session that has used one can no longer run a freshly fitted
    logistic model, whose training summary takes the session along."""
    table = materialize(df, name)
    return table, table.agg(*[column.alias(alias) for alias, column in totals.items()]).first().asDict()


def path_status(spark: SparkSession, path: str):
    """Hadoop's status of ``path`` on the file system that it names (the default one without a scheme); None if missing."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(at) if fs.exists(at) else None
