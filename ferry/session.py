"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ferry", checkpoint_dir: str | None = None) -> SparkSession:
    """A local[N] session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.speculation", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Without one, a local session uses a
    folder in its table store (``spark.sql.warehouse.dir``); on a cluster that
    folder may be the driver's own, so there the setting is needed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext here
        sc = None
    if sc is None:
        if not root:
            raise RuntimeError("spark.checkpoint.dir is unset: point it at a folder shared by the cluster")
        return root.rstrip("/")
    root = root or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: point it at a folder shared by the cluster")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_ferry_checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable; returns the RDD checkpoint folder."""
    checkpoint_root(spark)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for intermediate tables."""
    return os.path.join(checkpoint_root(spark), "ferry-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own, through Spark's file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
