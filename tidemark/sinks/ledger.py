"""Tables by path that streams, ingests and repairs write alike, each batch once.

    <table>/date=20240101/_batch=<writer>.<number>/part-…   rows, as any reader sees them
    <table>/_commits/<number>.json                          what has been committed
    <table>/_begun/<batch>                                  batches that are being written
    <table>/_days-0/_batch=…, <table>/_figures-0/_batch=…   facts about each batch

A batch is written into partitions of its own, by dynamic overwrite, so writing it again
replaces it.  Its commit record then takes the next number, which only one writer
gets; from there on the batch is skipped.  Readers leave out what has begun and is
not committed.  The record carries what a later run needs to know without reading
the table: the schema of all commits, the latest change, the last batch of each stream.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import asdict, dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timestamps import calendar_day, parse_timestamp_column
from tidemark.operators.reconcile import SPECS, merged_parts, partial_figures
from tidemark.sinks import records
from tidemark.sinks.schemas import check_same, fitted, merged

BATCH = "_batch"


class Behind(RuntimeError):
    """Somebody has committed since the state that a batch was made from."""


@dataclass(frozen=True)
class Settings:
    """What a table keeps facts about; settled when it is created.

    change: column whose latest value is the table's bookmark.
    day:    column whose days are listed per partition, so that a day's rows are found
            wherever repairs have put them.
    stream: the reconciliation (of `SPECS`) whose daily figures are kept per batch.
    """

    partition_by: tuple[str, ...] = ("date",)
    change: str | None = None
    day: str | None = None
    stream: str | None = None


@dataclass(frozen=True)
class State:
    """The latest commit; `number` 0 before the first."""

    number: int
    settings: Settings
    schema: T.StructType | None
    bookmark: str | None
    writers: dict[str, int]
    batch: str | None = None
    rows: int = 0
    facts: int = 0


def _at(path: str) -> str:
    return path.rstrip("/")


def is_ledger(spark: SparkSession, path: str) -> bool:
    return "/" in path and records.exists(spark, f"{_at(path)}/_commits")


def state(spark: SparkSession, path: str) -> State | None:
    """What the latest commit says; None if `path` is no such table."""
    number, record = records.latest(spark, f"{_at(path)}/_commits")
    if record is None:
        return None
    settings = Settings(**{**record["settings"], "partition_by": tuple(record["settings"]["partition_by"])})
    schema = T.StructType.fromJson(record["schema"]) if record["schema"] else None
    return State(number, settings, schema, record["bookmark"], record["writers"], record["batch"], record["rows"], record["facts"])


def _record(s: State) -> dict:
    schema = s.schema.jsonValue() if s.schema is not None else None
    return {"settings": asdict(s.settings), "schema": schema, "bookmark": s.bookmark, "writers": s.writers, "batch": s.batch, "rows": s.rows, "facts": s.facts}


def create(spark: SparkSession, path: str, settings: Settings | None = None) -> State:
    """Make `path` a table of this kind; its settings stay if it is one already."""
    known = state(spark, path)
    if known is None:
        if records.names(spark, path):
            raise ValueError(f"{path} holds files that no commit names")
        first = State(0, settings or Settings(), None, None, {})
        records.put(spark, f"{_at(path)}/_commits", 1, _record(first))
        known = state(spark, path)
    return known


def _begun(spark: SparkSession, path: str) -> list[str]:
    """Batches without a commit; the latest one may have lost its writer just after it was committed."""
    return [b for b in records.names(spark, f"{_at(path)}/_begun") if b != state(spark, path).batch]


def _committed(df: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Without the rows of batches that have begun only; a filter on partitions."""
    begun = _begun(spark, path)
    return (df.filter(~F.col(BATCH).isin(*begun)) if begun else df).drop(BATCH)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows, with every column the table ever had; no file is opened to find them."""
    s = state(spark, path)
    if s.schema is None:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in s.settings.partition_by]))
    return _committed(spark.read.schema(s.schema.add(BATCH, "string")).parquet(path), spark, path)


def _facts(spark: SparkSession, path: str, kind: str) -> DataFrame:
    rows = spark.read.option("mergeSchema", "false").parquet(f"{_at(path)}/_{kind}-{state(spark, path).facts}")
    return _committed(rows, spark, path)


def day_partitions(spark: SparkSession, path: str, day: date) -> list[str]:
    """The values of the first partition column under which rows of a day lie."""
    s = state(spark, path)
    if s.settings.day is None:
        raise ValueError(f"{path} keeps no days")
    if s.schema is None:
        return []
    found = _facts(spark, path, "days").filter(F.col("day") == F.lit(day)).select("partition").distinct()
    return sorted(r["partition"] for r in found.collect())


def rows_of_day(spark: SparkSession, path: str, day: date) -> DataFrame:
    """The rows of a table that may be of one day: only the partitions known to hold any are read.

    Rows of the day that a repair has appended lie in the partition of the repair,
    which the list names as well.  Other days' rows of those partitions come along.
    """
    first = state(spark, path).settings.partition_by[0]
    return read(spark, path).filter(F.col(first).isin(*day_partitions(spark, path, day)))


def figures(spark: SparkSession, path: str) -> DataFrame:
    """The mergeable daily figures of all committed batches (see `partial_figures`)."""
    s = state(spark, path)
    if s.settings.stream is None:
        raise ValueError(f"{path} keeps no figures")
    if s.schema is None:
        raise ValueError(f"{path} has no rows yet")
    return _facts(spark, path, "figures")


def _write(rows: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
    writer.partitionBy(*partition_by).parquet(path)


def _folders(path: str, batch: str, settings: Settings) -> str:
    """The folders of one batch's rows, as a glob pattern."""
    return "/".join([_at(path), *(f"{c}=*" for c in settings.partition_by), f"{BATCH}={batch}"])


def _keep_facts(spark: SparkSession, path: str, batch: str, settings: Settings, schema: T.StructType, facts: int) -> tuple[int, str | None]:
    """(rows, latest change) of one batch; its days and figures are kept.  All from the files just written, and no others.

    What a task that was run again would count twice while writing is counted once here.
    """
    own = _folders(path, batch, settings)
    if not records.found(spark, own):
        return 0, None
    rows = spark.read.schema(schema).option("basePath", path).parquet(own)
    change = settings.change
    latest = F.max(parse_timestamp_column(rows, change, strict=False)) if change in rows.columns else F.lit(None).cast("timestamp")
    count, mark = rows.agg(F.count(F.lit(1)), F.date_format(latest, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")).first()
    if settings.day and settings.day in rows.columns:
        days = rows.groupBy(F.col(settings.partition_by[0]).alias("partition"), calendar_day(rows, settings.day).alias("day")).agg(F.count(F.lit(1)).alias("n"))
        _write(days.withColumn(BATCH, F.lit(batch)), f"{_at(path)}/_days-{facts}", (BATCH,))
    if settings.stream:
        parts = partial_figures(SPECS[settings.stream], rows)
        _write(parts.withColumn(BATCH, F.lit(batch)), f"{_at(path)}/_figures-{facts}", (BATCH,))
    return count, mark


def commit(
    df: DataFrame, path: str, writer: str | None = None, number: int | None = None, *, after: int | None = None, settings: Settings | None = None
) -> int | None:
    """Append a batch once and return how many rows it has.

    `writer` and `number` name a batch of a numbered sequence, as a stream's: a number not
    above the writer's last one was committed before and gives None.  Without them
    the batch is one of its own.  `after` is the state number the batch was made from;
    a commit by anybody else since then raises `Behind` and the batch stays out.
    A batch that failed half way is written again in full.
    """
    spark = df.sparkSession
    known = create(spark, path, settings)
    if writer is not None and number <= known.writers.get(writer, -1):
        return None
    batch = f"{writer}.{number}" if writer is not None else f"one.{uuid.uuid4().hex}"
    partition_by = known.settings.partition_by
    if not re.fullmatch(r"[A-Za-z0-9.-]+", batch):
        raise ValueError(f"{writer!r} is no name for a writer: letters, digits, dots and dashes only")
    if BATCH in df.columns:
        raise ValueError(f"{BATCH} is a column of the table itself")
    rows = fitted(df, known.schema, partition_by)
    schema = merged(known.schema, rows.schema, partition_by)
    begun = f"{_at(path)}/_begun/{batch}"
    own = _folders(path, batch, known.settings)
    if records.exists(spark, begun):
        records.delete(spark, own)
    records.mark(spark, begun)
    _write(rows.withColumn(BATCH, F.lit(batch)).hint("rebalance", *partition_by), path, (*partition_by, BATCH))
    facts, written = known.facts, schema
    count, mark = _keep_facts(spark, path, batch, known.settings, written, facts)
    schema = schema if count else known.schema
    while True:
        now = state(spark, path)
        if now.facts != facts:
            # They were folded meanwhile: this batch's belong to the new ones.
            facts = now.facts
            _keep_facts(spark, path, batch, known.settings, written, facts)
        if after is not None and now.number != after:
            records.delete(spark, own)
            for kind in ("days", "figures"):
                records.delete(spark, f"{_at(path)}/_{kind}-*/{BATCH}={batch}")
            records.delete(spark, begun)
            raise Behind(f"{path} is at commit {now.number}, not {after}")
        if now.schema is not None and schema is not None:
            check_same(now.schema, schema)
            schema = merged(now.schema, schema, partition_by)
        marks = [m for m in (now.bookmark, mark) if m]
        writers = {**now.writers, writer: number} if writer is not None else now.writers
        record = State(0, known.settings, schema or now.schema, max(marks, default=None), writers, batch, count, facts)
        if records.put(spark, f"{_at(path)}/_commits", now.number + 1, _record(record)):
            break
    records.delete(spark, begun)
    if now.batch:
        # Its writer may have been lost before it could do this.
        records.delete(spark, f"{_at(path)}/_begun/{now.batch}")
    return count


def fold(spark: SparkSession, path: str) -> None:
    """Merge the facts of all committed batches, which are small files each, into few; to be run now and then.

    The folded facts are a version of their own, which counts from one commit record on; a commit that
    comes in between has the fold start again, and batches that are being written add their facts to
    the new version.  The version before stays for readers that have opened it, older ones go.
    """
    while True:
        s = state(spark, path)
        version = s.facts + 1
        if s.schema is not None and s.settings.day:
            days = _facts(spark, path, "days").groupBy("partition", "day").agg(F.sum("n").alias("n"))
            _write(days.withColumn(BATCH, F.lit("fold")).repartitionByRange("day"), f"{_at(path)}/_days-{version}", (BATCH,))
        if s.schema is not None and s.settings.stream:
            parts = merged_parts(SPECS[s.settings.stream], _facts(spark, path, "figures"))
            # In order of the day, which is what they are asked for by.
            _write(parts.withColumn(BATCH, F.lit("fold")).repartitionByRange("day").sortWithinPartitions("day"), f"{_at(path)}/_figures-{version}", (BATCH,))
        if records.put(spark, f"{_at(path)}/_commits", s.number + 1, _record(replace(s, facts=version))):
            break
    for kind in ("days", "figures"):
        records.delete(spark, f"{_at(path)}/_{kind}-{version - 2}")


def bookmark(spark: SparkSession, path: str) -> str | None:
    """The latest change of all committed rows, from the latest commit alone."""
    s = state(spark, path)
    return s.bookmark if s else None
