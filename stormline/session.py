"""The session settings that the library counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Times are UTC, plans adapt at run time, and a rebuild replaces only its own partitions."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
