"""Session settings the jobs are written for."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Adaptive execution merges small shuffle partitions and splits skewed ones, but never makes an aggregation wider than
# ``spark.sql.shuffle.partitions``. The width belongs to the cluster and the data: pass it as a keyword, a few times the
# number of cores or the shuffled bytes over 128 MB, whichever is larger.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.scheduler.mode": "FAIR",  # load steps that run side by side share the cluster
    "spark.sql.parquet.filterPushdown": "true",
}
DEFAULT_WIDTH = "200"


def get_session(app: str = "shelfweek", master: str | None = None, **conf: object) -> SparkSession:
    """Return a session with the package settings; keyword dots are written as double underscores."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(SETTINGS)
    merged.update({name.replace("__", "."): str(value) for name, value in conf.items()})
    for name, value in merged.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    if not session.conf.get("spark.master", "").startswith("local") and session.conf.get("spark.sql.shuffle.partitions") == DEFAULT_WIDTH:
        log.warning("spark.sql.shuffle.partitions is still %s; set it for this cluster and its data", DEFAULT_WIDTH)
    return session
