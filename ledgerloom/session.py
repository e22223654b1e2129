"""Spark sessions. A cluster sets its own sizes; only what results or plans depend on is set here."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.scheduler.mode": "FAIR",
    # Building a plan makes thousands of Column calls; do not record a Python stack for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app: str = "ledgerloom", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app: str = "ledgerloom", cores: str | int = 8, memory: str = "8g") -> SparkSession:
    """For tests and benchmarks on one machine: as many shuffle partitions as cores."""
    spark = session(
        app,
        **{
            "spark.master": f"local[{cores}]",
            "spark.driver.memory": memory,
            "spark.sql.shuffle.partitions": str(cores),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
