"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Clinical timestamps carry offsets; they are normalised to UTC.
    "spark.sql.session.timeZone": "UTC",
    # Run-time replanning: coalesces small partitions, splits skewed joins
    # and skewed rebalance writes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

CHECKPOINT_KEY = "spark.checkpoint.dir"


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the run-time options the library relies on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """An option of the session for the time of the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def build_session(app: str = "carebasin", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or get) a session. Cluster size options stay with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    It is the cluster's ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder; a cluster session without it fails,
    since executors cannot share a machine-local folder.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root is None:
        root = spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="carebasin-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared folder."""
    return f"{work_root(spark)}/carebasin/{label}-{uuid.uuid4().hex}"
