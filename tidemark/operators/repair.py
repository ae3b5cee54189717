"""Repair of rows that reached the source after their day was ingested."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.coerce import key_number
from tidemark.functions.timestamps import iso_text, on_day, yesterday
from tidemark.operators.diff import SOURCE_ONLY, compare_keys, keys_found
from tidemark.operators.reconcile import ReconSpec, check_counts, reconcile
from tidemark.operators.shape import run_time
from tidemark.plans.staging import restrict_to_keys


def ids_of_yesterday(df: DataFrame, day_column: str, run_ts: datetime, key: str = "id") -> DataFrame:
    """Keys of the day before the run, as numbers."""
    wanted = on_day(df, day_column, yesterday(run_ts.date()))
    return df.filter(wanted).select(key_number(F.col(key)).alias(key))


def late_rows(source: DataFrame, target: DataFrame, run_ts: datetime, *, key: str = "id", day_column: str = "creation_date") -> DataFrame:
    """Source rows whose key, seen yesterday, the target has not got for yesterday.

    The rows are stamped with the day and time of the run, not with their own day, and
    their day column is rendered as ISO text, ready to append.
    """
    compared = compare_keys(
        ids_of_yesterday(source, day_column, run_ts, key), ids_of_yesterday(target, day_column, run_ts, key), [key]
    )
    numbered = source.withColumn(key, key_number(F.col(key)))
    rows = restrict_to_keys(numbered, keys_found(compared, SOURCE_ONLY), [key])
    return rows.withColumns(
        {
            key: F.col(key).cast(source.schema[key].dataType),
            day_column: iso_text(F.to_timestamp(F.col(day_column))),
            "date": F.lit(run_ts.strftime("%Y%m%d")),
            "timestamp_extracted": run_time(run_ts),
        }
    )


def repair_and_reconcile(
    spec: ReconSpec,
    source: DataFrame,
    read_target: Callable[[], DataFrame],
    run_ts: datetime,
    append: Callable[[DataFrame], None] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Reconcile yesterday; when counts differ, find the late rows, append them and reconcile again.

    Returns the final reconciliation and the late rows (None when there are none).
    Without `append` nothing is written: a dry run.
    """
    first = reconcile(spec, source, read_target(), run_ts.date(), run_ts)
    if check_counts(first, spec).filter("status <> 0").isEmpty():
        return first, None
    late = late_rows(source, read_target(), run_ts, key=spec.key, day_column=spec.day)
    if late.isEmpty():
        return first, None
    if append is None:
        return first, late
    append(late)
    return reconcile(spec, source, read_target(), run_ts.date(), run_ts), late
