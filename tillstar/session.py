"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Joins broadcast a side only when Catalyst's own size estimate (file sizes of
# the dimension tables) or AQE's measured shuffle size stays below these; any
# larger side is shuffled, with AQE splitting skewed partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "tillstar", **settings: str) -> SparkSession:
    """A session with the defaults above; the cluster's own settings come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="run-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder of the session.

    Only a local session without such a folder falls back to a temporary one:
    executors on other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
