"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# ANSI stays on: a bad cast must fail a table (or use try_cast), never turn into
# silent NULLs.  AQE picks the join strategy from measured sizes and splits skewed
# partitions, so the library carries no broadcast hints and no partition counts.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.scheduler.mode": "FAIR",
}

# For a large cluster, to pass to build_session.  Aggregates cannot be split after the fact, so the
# shuffle starts with many partitions (about shuffled bytes / 128 MB); AQE joins the small ones.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app_name: str = "tablescout", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
