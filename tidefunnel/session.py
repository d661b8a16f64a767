"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only for sessions we build ourselves (tests, bench); a cluster brings its own.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tidefunnel")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )


_LOCAL_ROOTS: dict[str, str] = {}


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written intermediate tables.

    It lies below the shared folder that the cluster names in
    ``spark.checkpoint.dir``.  Only a local session without that setting gets
    a temporary folder, because there executor and driver share one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS.setdefault(app, "") or tempfile.mkdtemp(prefix="tidefunnel-")
        _LOCAL_ROOTS[app] = root
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
