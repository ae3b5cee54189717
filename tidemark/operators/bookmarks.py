"""Bookmarks: how far each stream has been read.

State is a small table, one row per stream (and sub-stream).  Its history is kept by
appending; the latest version of a row is the state.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.naming import snake_words
from tidemark.functions.timestamps import add_second_text
from tidemark.operators.shape import run_time

STATE_SCHEMA = "stream string, substream string, bookmark string"
# Sub-streams are always read again from the beginning.
BEGINNING = "2020-01-01T00:00:00.000000Z"
BEGINNING_SECONDS = "2020-01-01T00:00:00Z"
SECONDS_SUBSTREAMS = ("EQUITY",)
YESTERDAY_LAYOUT = "%Y-%m-%dT00:00:00.000000Z"


def high_water_mark(df: DataFrame, cdc_field: str, partition: str | None = None) -> DataFrame:
    """One row `bookmark`: the latest change, as ISO text in UTC; an empty table is an error.

    `partition` names a partition column that grows with the change field; then only
    its newest value is read.  Not for tables that repairs or backfills append to,
    whose rows lie in the partition of the day they were appended.
    """
    if partition:
        df = df.filter(F.col(partition) == df.agg(F.max(partition)).scalar())
    latest = F.max(F.col(snake_words(cdc_field)).cast("timestamp"))
    text = F.date_format(latest, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(latest, "SSSSSS")
    iso = F.concat(text, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit("")), F.lit("+00:00"))
    missing = F.raise_error(F.lit(f"no value of {cdc_field} to start from")).cast("string")
    return df.agg(F.coalesce(iso, missing).alias("bookmark"))


def beginning(substream: Column) -> Column:
    return F.when(substream.isin(*SECONDS_SUBSTREAMS), BEGINNING_SECONDS).otherwise(BEGINNING)


def initial_state(df: DataFrame) -> DataFrame:
    """(stream, substream) pairs with the bookmark a full read starts from."""
    return df.select("stream", "substream", beginning(F.col("substream")).alias("bookmark"))


def advance_bookmarks(state: DataFrame, status: DataFrame) -> DataFrame:
    """One second past the bookmark for streams that were updated.

    Sub-streams go back to the beginning instead, plus the same second.  Streams that
    were not updated, or are no longer run, keep their bookmark.
    """
    updated = status.filter("updated").select(F.col("stream").alias("__stream")).distinct()
    joined = state.join(updated, state["stream"] == updated["__stream"], "left")
    base = F.when(F.col("substream").isNull(), F.col("bookmark")).otherwise(beginning(F.col("substream")))
    moved = F.when(F.col("__stream").isNotNull(), add_second_text(base)).otherwise(F.col("bookmark"))
    return joined.select("stream", "substream", moved.alias("bookmark"))


def archive_state(state: DataFrame, path: str, run_ts: datetime) -> None:
    """Append this state to the history."""
    state.withColumn("saved_at", run_time(run_ts)).write.mode("append").parquet(path)


def latest_state(history: DataFrame) -> DataFrame:
    """The newest bookmark of each stream and sub-stream."""
    newest = F.max_by("bookmark", "saved_at").alias("bookmark")
    return history.groupBy("stream", "substream").agg(newest)


def load_state(history: DataFrame | None, initial: DataFrame) -> DataFrame:
    """The latest state, or the initial one before the first run."""
    return initial if history is None or history.isEmpty() else latest_state(history)
