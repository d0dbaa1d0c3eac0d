"""Session settings. Cluster sizing stays with spark-submit; these are the semantics we rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split hot ones,
    # turn joins whose measured side is small into broadcast joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition even if the step above the join then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Recording the Python call site of every expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(app: str = "wardbook", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
