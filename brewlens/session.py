"""Spark session settings and the shared working folder.

Everything here is configuration a Spark user would set: UTC session time,
AQE (coalescing and skew-join splitting), Arrow for pandas UDFs and the UI off.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "brewlens") -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("BREWLENS_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """SQL settings that can change on a running session (the driver's own session)."""
    for key, value in SESSION_CONF.items():
        if key.startswith("spark.sql."):
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf on an already started session
                pass


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (a cluster names a shared file system
    there). Only where it is unset -- a local test session -- a folder of our
    own is created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:
            root = None
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on the cluster's shared file system")
        # a local test session only: a folder of our own on this machine
        root = tempfile.mkdtemp(prefix="brewlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:
        pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def merging(df):
    """A side of a join that grows with the input: the join is to shuffle and merge, never to broadcast.

    What Spark takes for the size of a table read from files is their compressed size, exploded arrays and the rows
    that Python steps make are not counted at all, and checkpoints hand such sizes on.  Small by that measure, a side of
    millions of rows would pass through the driver's memory.
    """
    return df.hint("merge")


SPREAD_CONF = "brewlens.scan.spread"


def spread(df):
    """Deal a text table's rows over as many partitions as ``brewlens.scan.spread`` says.

    Unset (the default) the scan stays as it is.  It is a deployment setting for
    tables kept as one small file with one row group, which no scan can split.
    """
    partitions = df.sparkSession.conf.get(SPREAD_CONF, None)
    return df.repartition(int(partitions)) if partitions else df
