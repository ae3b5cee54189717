"""Table and report writers.

Partitioned writes pass through REBALANCE: AQE then gives each partition value few,
evenly sized files, and splits a value that holds much of the batch over many tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.catalog import TableCatalog, with_comments
from tidemark.sinks import ledger, schemas

def _insert(df: DataFrame, table: str, overwrite: bool) -> None:
    """Into an existing catalog table: columns it lacks are added, columns the batch lacks are null.

    With `overwrite` only the partitions the batch holds rows for are replaced.
    """
    spark = df.sparkSession
    known = spark.table(table).schema
    added = [T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema if f.name not in known.names]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({T.StructType(added).toDDL()})")
    # An insert matches by position.
    columns = [
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(table).schema
    ]
    if not overwrite:
        return df.select(*columns).write.insertInto(table)
    # Into a table of the catalog only a setting tells which partitions an overwrite replaces; a session of its own has it.
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    view = f"batch_{uuid.uuid4().hex}"
    df.select(*columns).createGlobalTempView(view)
    try:
        own.sql(f"INSERT OVERWRITE TABLE {table} SELECT * FROM global_temp.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)
    spark.catalog.refreshTable(table)


def _refuse_stream_sink(spark: SparkSession, path: str) -> None:
    """A folder that a streaming file sink keeps its own list of files for: readers would not see what is appended."""
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_spark_metadata")
    if log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log):
        raise ValueError(f"{path} is written by a stream; rows appended to it would not be read back")


def _save(
    df: DataFrame, target: str, mode: str, partition_by: tuple[str, ...], dynamic: bool, comments: dict[str, str] | None
) -> None:
    spark, by_path, whole = df.sparkSession, "/" in target, mode == "overwrite" and not dynamic
    if ledger.is_ledger(spark, target):
        if mode == "append":
            ledger.commit(df, target)
            return None
        raise ValueError(f"{target} is written batch by batch; its partitions cannot be replaced")
    df = with_comments(df, comments) if comments else df
    if by_path and not whole:
        _refuse_stream_sink(spark, target)
        known = schemas.schema_of(spark, target)
        df = schemas.fitted(df, known, partition_by)
    kept = schemas.merged(None if whole or not by_path else known, df.schema, partition_by)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if not by_path and not whole and spark.catalog.tableExists(target):
        return _insert(df, target, overwrite=dynamic)
    if by_path and not whole:
        # Logged first: a column no file has yet reads as null, one the log lacks would not be read.
        schemas.keep(spark, target, kept)
    writer = df.write.mode(mode).format("parquet").option("compression", "snappy")
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if not by_path:
        return writer.saveAsTable(target)
    writer.save(target)
    if whole:
        schemas.keep(spark, target, kept)
    return None


def append(df: DataFrame, target: str, partition_by: tuple[str, ...] = ("date",), comments=None) -> None:
    """Add rows; new columns are allowed, older files read them as null.

    By path, the batch takes the types of the columns the table has had so far (see
    `schemas`); a value that does not fit is an error before anything is written.
    A table that streams write (see `ledger`) gets the rows as one committed batch.
    """
    _save(df, target, "append", partition_by, False, comments)


def overwrite_partitions(df: DataFrame, target: str, partition_by: tuple[str, ...] = ("date",), comments=None) -> None:
    """Replace the partitions the batch holds rows for; all others stay."""
    _save(df, target, "overwrite", partition_by, True, comments)


def overwrite_table(df: DataFrame, target: str, partition_by: tuple[str, ...] = (), comments=None) -> None:
    """Replace the whole table."""
    _save(df, target, "overwrite", partition_by, False, comments)


def append_csv(df: DataFrame, path: str, catalog: TableCatalog) -> None:
    """Append rows as CSV, cast to and ordered by the catalog's columns."""
    columns = [F.col(name).cast(kind).alias(name) for name, kind in catalog.types.items()]
    df.select(*columns).write.mode("append").option("header", "true").csv(path)


def read_csv(spark: SparkSession, path: str, catalog: TableCatalog) -> DataFrame:
    return spark.read.option("header", "true").schema(catalog.schema()).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A difference report as CSV; nested values as JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    flat = {f.name: F.to_json(F.col(f.name)) for f in df.schema if isinstance(f.dataType, nested)}
    (df.withColumns(flat) if flat else df).write.mode("errorifexists").option("header", "true").csv(path)


def debug_path(root: str, table: str, source: str, run_ts: datetime) -> str:
    return f"{root}/debug_{table}_{source}/{run_ts:%Y%m%d}/{run_ts:%H%M%S}.csv"


def write_debug_snapshot(df: DataFrame, root: str, table: str, source: str, run_ts: datetime) -> str:
    """Keep the source rows a failed check was computed from."""
    path = debug_path(root, table, source, run_ts)
    write_report(df, path)
    return path


STATUS_SCHEMA = "stream string, updated boolean, error string"


def write_streams(spark: SparkSession, jobs: Iterable[tuple[str, Callable[[], bool]]]) -> DataFrame:
    """Run one write per stream and record how it went; one failure does not stop the rest.

    A job returns False when its stream had no new data.
    """
    results = []
    for stream, job in jobs:
        try:
            results.append((stream, bool(job()), None))
        except Exception as failure:  # any failure is that stream's result
            results.append((stream, False, str(failure)))
    return spark.createDataFrame(results, STATUS_SCHEMA)
