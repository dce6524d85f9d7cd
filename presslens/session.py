"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Settings every deployment should carry.  Sizes that depend on the cluster (executors, shuffle
#: partitions) are left to spark-submit; adaptive execution coalesces and splits partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", app: str = "presslens", **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def require_utc(spark: SparkSession) -> None:
    """Hour buckets are defined in UTC, so a session in another zone is refused."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone!r}")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one named by ``spark.checkpoint.dir``.

    Without that setting the folder lies below ``spark.sql.warehouse.dir``.  On a cluster one of the
    two has to name a folder that driver and executors share.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
