"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime re-planning does the work that would otherwise need hints: it turns
# shuffled joins into broadcast joins once a side is measured to be small, splits
# skewed join partitions and evens out REBALANCE-d writes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # `date=20240101` must read back as text, as it was written.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Repeated keys in one JSON object: the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
