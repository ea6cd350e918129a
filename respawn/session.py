"""Spark session defaults for the telemetry engine.

The library never hard-codes cluster sizing; these are the settings every job
relies on for *semantics* (UTC, ANSI) plus sane defaults for AQE. On a cluster
the submitter's own settings win because ``getOrCreate`` reuses the session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SEMANTIC_CONF = {
    # Event times are UTC wall-clock; every date bucket depends on this.
    "spark.sql.session.timeZone": "UTC",
    # Bad input must surface as NULL via try_* functions, never silently.
    "spark.sql.ansi.enabled": "true",
}

PERF_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hot players / hot days get their partial aggregates merged map-side; AQE
    # splits any skewed shuffle partition that still remains.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # ``mode()`` keeps a tiny value->count map per group in an object hash
    # aggregate; the default falls back to sort-based aggregation after 128
    # groups per task, far too early for one group per player.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Skip per-call Python call-site capture while building plans (driver-side
    # overhead only; error messages keep the JVM context).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "respawn",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's required settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(PERF_CONF)
    conf.update(SEMANTIC_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_semantics(spark)
    return spark


def ensure_semantics(spark: SparkSession) -> None:
    """Pin the settings results depend on (safe to call on any session)."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared lineage-cut folder.

    On a cluster ``spark.checkpoint.dir`` names a shared filesystem folder and is
    used as is (unset on a cluster is an error). Only in local mode with the
    setting unset (tests) is a folder created under the system temp folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on the cluster's shared "
                               "filesystem; a machine-local folder is not visible to executors")
        d = tempfile.mkdtemp(prefix="respawn-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table of this application in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/respawn-silver/{spark.sparkContext.applicationId}/{name}"


def _filesystem(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever filesystem its URI names."""
    fs, where = _filesystem(spark, path)
    return fs.exists(where)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; ``target`` must not exist (where it does, nothing is moved and an error raised)."""
    fs, src = _filesystem(spark, source)
    dst = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise OSError(f"can't rename {source} to {target}")


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, where = _filesystem(spark, path)
    fs.create(where, True).close()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, if it is there."""
    fs, where = _filesystem(spark, path)
    fs.delete(where, True)


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed (ms), 0 if it isn't there."""
    fs, where = _filesystem(spark, path)
    return fs.getFileStatus(where).getModificationTime() if fs.exists(where) else 0


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; nothing may read them any more."""
    fs, where = _filesystem(spark, scratch_path(spark, ""))
    fs.delete(where, True)
