"""Tables whose rows are replaced by key: hash buckets of keys, rewritten where a batch touches them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.staging import new_path, release, stage
from tidemark.sinks import records, schemas

BUCKET = "_bucket"
BUCKETS = 64


def _layout(spark: SparkSession, path: str, key: str, buckets: int) -> int:
    """The number of buckets of a table; settled by its first writer."""
    folder = f"{path.rstrip('/')}/_layout"
    records.put(spark, folder, 1, {"key": key, "buckets": buckets}) if not records.exists(spark, folder) else None
    _, known = records.latest(spark, folder)
    if known["key"] != key:
        raise ValueError(f"{path} is keyed by {known['key']}, not {key}")
    return known["buckets"]


def is_keyed(spark: SparkSession, path: str) -> bool:
    return "/" in path and records.exists(spark, f"{path.rstrip('/')}/_layout")


def read_keyed(spark: SparkSession, path: str, keys: list | None = None) -> DataFrame:
    """The rows of a keyed table; with `keys`, of these only, from their buckets only."""
    schema = schemas.logged_schema(spark, path)
    rows = spark.read.schema(schema).parquet(path)
    if keys is not None:
        _, known = records.latest(spark, f"{path.rstrip('/')}/_layout")
        kind = schema[known["key"]].dataType
        wanted = spark.createDataFrame([(k,) for k in keys], T.StructType([T.StructField("k", kind)]))
        found = {r[0] for r in wanted.select(_bucket("k", known["buckets"])).distinct().collect()}
        rows = rows.filter(F.col(BUCKET).isin(*found)).filter(F.col(known["key"]).isin(*keys))
    return rows.drop(BUCKET)


def _bucket(key: str, buckets: int):
    return F.lpad(F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("string"), 5, "0").alias(BUCKET)


def replace_keys(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """For every key of the batch, its rows replace the table's; all other keys stay.

    The number of directories is `buckets` however many keys there are.  Of the touched
    buckets the other keys' rows are copied, next to the batch, to a staged table, which then takes
    their place in one dynamic overwrite: a reader or a rerun after a failure sees a
    bucket before or after, and running the batch again gives the same table.  A
    bucket holds all rows of its keys; one that holds much is written by many tasks.
    Only one writer at a time may replace keys of a table.
    """
    spark = df.sparkSession
    buckets = _layout(spark, path, key, buckets)
    known = schemas.logged_schema(spark, path)
    batch_path, next_path = new_path(spark, "keyed-batch"), new_path(spark, "keyed")
    try:
        batch = stage(schemas.fitted(df, known, (BUCKET,)).withColumn(BUCKET, _bucket(key, buckets)), path=batch_path)
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]
        if not touched:
            return
        schema = schemas.merged(known, df.sparkSession.createDataFrame([], batch.schema).schema, (BUCKET,))
        rows = batch
        if known is not None:
            replaced = batch.select(F.col(key).alias("__key")).distinct()
            old = spark.read.schema(known).parquet(path).filter(F.col(BUCKET).isin(*touched))
            stays = old.join(replaced, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
            rows = stays.unionByName(batch, allowMissingColumns=True)
        whole = stage(rows.select(*schema.names).hint("rebalance", BUCKET), path=next_path)
        schemas.keep(spark, path, schema)
        writer = whole.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.option("compression", "snappy").partitionBy(BUCKET).parquet(path)
    finally:
        release(spark, batch_path)
        release(spark, next_path)
