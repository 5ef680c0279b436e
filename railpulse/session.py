"""Session settings the results rest on, and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session clock to UTC.

    Instants are TIMESTAMP and wall-clock values TIMESTAMP_NTZ; converting one
    into the other follows the session zone, so it has to be the same
    everywhere.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: str = "*", app: str = "railpulse", **conf: str) -> SparkSession:
    """A session for one machine: tests, the bench, a laptop."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


@functools.cache
def _machine_folder() -> str:
    return tempfile.mkdtemp(prefix="railpulse-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, below ``spark.checkpoint.dir``.

    The cluster names a folder every executor can reach. Without one, only a
    session whose executors share this machine may use a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = _machine_folder()
    return f"{root.rstrip('/')}/railpulse/{name}-{uuid.uuid4().hex}"
