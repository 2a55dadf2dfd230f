"""Session settings that the jobs profit from."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins of partitions that prove small at run time hash instead of sorting;
# larger ones keep the sort that can spill. Skewed partitions are split.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
