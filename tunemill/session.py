"""A session with the few settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_session(app: str = "tunemill", master: str | None = None, **settings: str) -> SparkSession:
    """Get or create a session; what the cluster has set stays as it is.

    Settings are given with ``__`` for each dot.  The number of shuffle
    partitions is left to the cluster: adaptive execution joins small ones,
    so a high number is the safe one for large data.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    fixed = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for name, value in (fixed | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The shared folder for tables between jobs that the cluster names; a temporary one only where nothing is shared."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tunemill-")
