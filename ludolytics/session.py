"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # naive timestamps in the data model mean UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # joins carry no broadcast hints: adaptive execution compares the measured
    # size of a side with the broadcast threshold, and past it keeps the
    # shuffled join and splits its hot partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot partitions even when the split costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows go to Python workers in batches of bounded size, however long they are
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan in this package relies on."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "ludolytics", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` session, whose executor is the driver, may leave it unset and gets a temporary folder. On a
    cluster such a folder would be another one on every machine, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="ludolytics-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
