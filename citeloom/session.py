"""Spark sessions with the settings that the engine wants."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: AQE re-plans joins and splits skewed partitions; timestamps are UTC.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "citeloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()
