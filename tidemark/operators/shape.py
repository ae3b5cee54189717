"""Shaping a batch of records: meta columns, empty columns, leftover columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timestamps import day_text, parse_timestamp_column

NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def run_time(run_ts: datetime) -> Column:
    return F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def add_meta(df: DataFrame, run_ts: datetime, cdc_field: str | None = None) -> DataFrame:
    """Partition day and extraction time.

    The day is that of the change field (parsed in place) when there is one, else
    the day of the run.
    """
    if cdc_field:
        df = df.withColumn(cdc_field, parse_timestamp_column(df, cdc_field))
        day = day_text(F.col(cdc_field))
    else:
        day = F.lit(run_ts.strftime("%Y%m%d"))
    return df.withColumns({"date": day, "timestamp_extracted": run_time(run_ts)})


def nested_as_text(df: DataFrame) -> DataFrame:
    """Structs, arrays, maps and variants as JSON text; other columns unchanged."""
    nested = {f.name: F.to_json(F.col(f.name)) for f in df.schema if isinstance(f.dataType, NESTED)}
    return df.withColumns(nested) if nested else df


def record_table(df: DataFrame, run_ts: datetime, flat: bool) -> DataFrame:
    """A record list as a table stamped with the run's day and time."""
    return add_meta(df if flat else nested_as_text(df), run_ts)


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns without any value, found by one aggregate over the batch."""
    if not df.columns:
        return df
    counts = df.agg(*[F.count(F.col(name)).alias(name) for name in df.columns]).first()
    return df.select(*[name for name in df.columns if counts[name] > 0])


def leftovers_as_text(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """Nested columns no catalog lists become text and join the types.

    Returns the frame and the types of all its columns.
    """
    unlisted = {
        f.name: F.to_json(F.col(f.name)) if isinstance(f.dataType, NESTED) else F.col(f.name).cast("string")
        for f in df.schema
        if f.name not in types and isinstance(f.dataType, (*NESTED, T.StringType, T.NullType))
    }
    if unlisted:
        df = df.withColumns(unlisted)
    return df, {**types, **{name: "string" for name in unlisted}}
