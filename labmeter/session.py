"""Spark settings the library counts on. Times are UTC, so the session must be too."""

from __future__ import annotations

from pyspark.sql import SparkSession

from labmeter.streaming.state import STATE_STORE

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.cache.maxEntries": "2000",  # a report has some hundred plans
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings; partition counts and memory are the cluster's own matter."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
