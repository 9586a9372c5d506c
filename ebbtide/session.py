"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles, turns small joins into broadcast joins by measured size
# and splits skewed join partitions even where that costs the next aggregation an exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Trials of a search have a pool each; without pools this is the same as first in, first out.
    "spark.scheduler.mode": "FAIR",
}


def build_session(app_name: str = "ebbtide", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; the cluster's own configuration fills in the rest."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name inside the folder every executor can reach.

    That is ``spark.checkpoint.dir``. Only a local master may go without it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="ebbtide-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
