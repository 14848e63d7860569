"""Session helpers.

The library never creates a session inside an operator.  `local_session` is for
tests, the bench and the examples; on a cluster the caller brings its own
session.  Shared scratch space (landed files, checkpoints, state tables) always
lives under the folder the cluster names in `spark.checkpoint.dir`; only when that
setting is unset and the master is local (tests) is a fresh temporary folder taken and
registered.  On a cluster without the setting it is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "postlytics", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a temporary one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - not set at all
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir is not set; with master {sc.master} executors need a shared folder")
        configured = tempfile.mkdtemp(prefix="postlytics-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def open_writers(spark: SparkSession, files: int):
    """Writes into partition folders keep up to `files` files of a task open at once, so that they
    need no sort (and no spill) of the rows by folder; beyond that number Spark sorts as usual."""
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(files))


def shuffles_dropped(spark: SparkSession):
    """The shuffle files behind a write are removed as the write ends, not when the driver happens to
    collect its garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "postlytics", f"{name}-{uuid.uuid4().hex[:12]}")
