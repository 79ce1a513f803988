"""Session settings for jobs, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Compare in-memory rather than ZSTD file sizes with the broadcast limit.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.ui.enabled": "false",
}


def build_session(name: str = "grantlens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the plans are written for.

    Cluster sizing (executors, shuffle partitions, the shared folder in
    spark.checkpoint.dir) belongs to the submit command.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
