"""Chunked backfill: planning time chunks, running them, summarising the outcome."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATUS_SCHEMA = "chunk_num int, start_date string, end_date string, status string, records_count bigint, error string"
LAYOUT = "%Y-%m-%d %H:%M:%S"
SUCCESS, FAILURE = "success", "failure"
# Outcome of a run.
ALL_OK, FATAL, SOME_FAILED = 0, 1, 2


def plan_chunks(spark: SparkSession, start: datetime, end: datetime, hours: int = 24) -> DataFrame:
    """Consecutive chunks from `start`, the last one cut off at `end`; numbered from 1."""
    if hours <= 0:
        raise ValueError("chunk length must be positive")
    count = max(0, -((start - end) // timedelta(hours=hours)))
    first, last = (F.lit(t.strftime(f"{LAYOUT}.%f")).cast("timestamp") for t in (start, end))
    begin = F.timestamp_add("HOUR", F.col("id") * hours, first)
    stop = F.least(F.timestamp_add("HOUR", (F.col("id") + 1) * hours, first), last)
    return spark.range(count).select(
        (F.col("id") + 1).cast("int").alias("chunk_num"), begin.alias("start_date"), stop.alias("end_date")
    )


def chunk_numbers(moment: Column, start: Column, end: Column, hours: int, half_open: bool = False) -> Column:
    """The chunks an instant belongs to, by arithmetic; empty outside the range.

    Chunks include both ends, so an instant on an inner boundary belongs to two of
    them.  `half_open` chunks leave out their end, except the last.
    """
    length = hours * 3_600_000_000
    offset = F.unix_micros(moment) - F.unix_micros(start)
    index = F.floor(offset / F.lit(length)).cast("int") + 1
    span = F.unix_micros(end) - F.unix_micros(start)
    last = F.ceil(span / F.lit(length)).cast("int")
    on_boundary = (offset % length == 0) & (index > 1)
    if half_open:
        numbers = F.array(F.least(index, last))
    else:
        numbers = (
            F.when(on_boundary & (index > last), F.array(last))
            .when(on_boundary, F.array(index - 1, index))
            .otherwise(F.array(index))
        )
    inside = (moment >= start) & (moment <= end)
    return F.when(inside, numbers).otherwise(F.array().cast("array<int>"))


def chunk_counts(
    df: DataFrame, column: str, start: Column, end: Column, hours: int = 24, half_open: bool = False
) -> DataFrame:
    """Rows per chunk in one pass; chunks without rows are not listed."""
    numbers = chunk_numbers(F.col(column).cast("timestamp"), start, end, hours, half_open)
    return df.select(F.explode(numbers).alias("chunk_num")).groupBy("chunk_num").agg(F.count("*").alias("records_count"))


def landed_by_chunk(rows: DataFrame, column: str, start: datetime, end: datetime, hours: int, path: str) -> Callable[[int], DataFrame]:
    """Write the rows of all chunks once, a folder per chunk; the result reads the rows of one.

    Rows are labelled by arithmetic, so a plan of any number of chunks is one scan, and a
    chunk reads its own folder only.  A row on a boundary goes to both its chunks; rows
    outside the range go to none.  REBALANCE splits a chunk that holds much of the rows.
    """
    first, last = (F.lit(str(t)).cast("timestamp") for t in (start, end))
    labelled = rows.withColumn("__chunk", F.explode(chunk_numbers(F.col(column).cast("timestamp"), first, last, hours)))
    labelled.hint("rebalance", "__chunk").write.partitionBy("__chunk").parquet(path)
    stored = rows.sparkSession.read.schema(labelled.schema).parquet(path)
    return lambda number: stored.filter(F.col("__chunk") == number).drop("__chunk")


def run_chunks(plan: DataFrame, job: Callable[[datetime, datetime], int]) -> DataFrame:
    """Run `job(start, end)` for each chunk in order; a failing chunk does not stop the rest.

    Each job is itself a Spark job; only the plan, one row per chunk, is on the driver.
    """
    spark, results = plan.sparkSession, []
    for chunk in plan.orderBy("chunk_num").toLocalIterator():
        row = [chunk.chunk_num, str(chunk.start_date), str(chunk.end_date)]
        try:
            results.append((*row, SUCCESS, int(job(chunk.start_date, chunk.end_date)), None))
        except Exception as failure:  # any failure is that chunk's result
            results.append((*row, FAILURE, None, str(failure)))
    return spark.createDataFrame(results, STATUS_SCHEMA)


def summarise_chunks(status: DataFrame) -> DataFrame:
    """One row: chunks, how many succeeded and failed, records, and the outcome code."""
    failed = F.count(F.when(F.col("status") == FAILURE, 1))
    return status.agg(
        F.count("*").alias("chunks"),
        F.count(F.when(F.col("status") == SUCCESS, 1)).alias("succeeded"),
        failed.alias("failed"),
        F.coalesce(F.sum(F.when(F.col("status") == SUCCESS, F.col("records_count"))), F.lit(0)).alias("records"),
        F.when(failed > 0, SOME_FAILED).otherwise(ALL_OK).alias("outcome"),
    )


def backfill(
    spark: SparkSession, start: datetime, end: datetime, hours: int, job: Callable[[datetime, datetime], int]
) -> tuple[int, DataFrame | None]:
    """Plan, run, summarise.  The code is 0 for success, 2 when chunks failed, 1 when the plan could not be run."""
    try:
        status = run_chunks(plan_chunks(spark, start, end, hours), job)
        return summarise_chunks(status).first().outcome, status
    except Exception:  # the run as a whole failed
        return FATAL, None


def read_time(text: str) -> datetime:
    """`LAYOUT`, with or without a fraction of a second."""
    return datetime.strptime(text, f"{LAYOUT}.%f" if "." in text else LAYOUT)


def parse_range(start: str, end: str | None, now: datetime) -> tuple[datetime, datetime]:
    """The range of a backfill event; it ends now unless it says otherwise."""
    first = read_time(start)
    last = read_time(end) if end else now.replace(microsecond=0)
    if first > last:
        raise ValueError("start is after end")
    return first, last


