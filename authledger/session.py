"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that results depend on; set on any session that is handed in.
SETTINGS = {
    # Year columns are taken from timestamps in the session zone.
    "spark.sql.session.timeZone": "UTC",
}
# Settings that plans count on, Spark's own defaults; left alone on a session that is handed in.
PLAN_SETTINGS = {
    # Post-shuffle sizing, skewed sort-merge joins and rebalanced writes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app_name: str = "authledger", **extra: str) -> SparkSession:
    """Session for the batch jobs.

    ``spark.sql.shuffle.partitions`` is left to the submitter: it is the upper
    limit AQE coalesces from, so size it as (largest shuffle / 200 MB).
    """
    builder = SparkSession.builder.appName(app_name).config(
        # Recording the Python line of every column expression slows plan building.
        "spark.python.sql.dataFrameDebugging.enabled",
        "false",
    )
    for key, value in {**SETTINGS, **PLAN_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run below the shared folder of the cluster.

    A cluster has to name that folder. In local mode, where one machine runs everything, a
    folder of its own is set for the session when none is.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="authledger-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/authledger/{purpose}-{uuid.uuid4().hex}"
