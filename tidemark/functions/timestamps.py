"""Timestamp parsing and rendering (the session time zone is UTC)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted layouts, tried in this order after ISO-8601.  The shape is
# tested first because a failed parse costs far more than a failed match.
ISO_8601 = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d{1,9})?)?)?\s?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
DATE_LIKE = r"^\d{1,4}[-/]\d"
LAYOUTS = (
    ("yyyy-M-d H:m:s", r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"),
    ("M/d/yyyy h:m:s a", r"(?i)^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2} [AP]M$"),
    ("d-M-yyyy H:m:s", r"^\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{1,2}:\d{1,2}$"),
    ("yyyy-d-M H:m:s", r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"),
)
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _first_match(text: Column) -> Column:
    # Each layout is tried only where the earlier ones gave null.
    iso = F.when(text.rlike(ISO_8601), F.try_to_timestamp(text))
    others = [F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(layout))) for layout, shape in LAYOUTS]
    return F.when(text.rlike(DATE_LIKE), F.coalesce(iso, *others))


def try_parse_timestamp(column: Column) -> Column:
    """First matching layout, null where none matches."""
    return _first_match(F.nullif(column.cast("string"), F.lit("")))


def parse_timestamp(column: Column, label: str = "value") -> Column:
    """First matching layout; null and empty give null, anything else is an error."""
    text = F.nullif(column.cast("string"), F.lit(""))
    failure = F.raise_error(F.concat(F.lit("cannot read date "), text, F.lit(f" in {label}")))
    return F.coalesce(_first_match(text), F.when(text.isNotNull(), failure.cast("timestamp")))


def parse_timestamp_column(df: DataFrame, name: str, strict: bool = True) -> Column:
    """As above for a named column; columns that are already temporal pass through."""
    if isinstance(df.schema[name].dataType, T.StringType):
        column = F.col(name)
        return parse_timestamp(column, name) if strict else try_parse_timestamp(column)
    return F.col(name).cast("timestamp")


def parse_layout(column: Column, layout: str | None = None) -> Column:
    """One fixed layout (ISO-8601 when none is given); other text is an error."""
    return F.to_timestamp(column, layout) if layout else F.to_timestamp(column)


def parse_catalogued(df: DataFrame, types: dict[str, str], layout: str | None = None) -> DataFrame:
    """Parse the columns a catalog calls timestamps, except the extraction time."""
    wanted = [c for c in df.columns if types.get(c) == "timestamp" and c != "timestamp_extracted"]
    text = [c for c in wanted if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: parse_layout(F.nullif(F.col(c), F.lit("")), layout) for c in text}) if text else df


def iso_text(column: Column) -> Column:
    """Timestamp as ISO text with microseconds and a `Z`."""
    return F.date_format(column, ISO_MICROS)


def add_second_text(column: Column) -> Column:
    """One second later, in the layout the ISO text already has."""
    later = F.to_timestamp(column) + F.expr("INTERVAL 1 SECOND")
    return F.when(column.contains("."), F.date_format(later, ISO_MICROS)).otherwise(
        F.date_format(later, ISO_SECONDS)
    )


def day_text(column: Column) -> Column:
    """`yyyyMMdd`, the lake's partition value."""
    return F.date_format(column, "yyyyMMdd")


def calendar_day(df: DataFrame, name: str) -> Column:
    """The day of a timestamp column, or of the first ten characters of a text one."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.to_date(F.substring(F.col(name), 1, 10), "yyyy-MM-dd")
    return F.to_date(F.col(name))


def on_day(df: DataFrame, name: str, day: date) -> Column:
    """Rows of one day, as a comparison on the stored column so that it reaches the scan."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return column.startswith(day.isoformat())
    if isinstance(kind, T.DateType):
        return column == F.lit(day)
    low, high = (F.lit(d.isoformat()).cast(kind) for d in (day, day + timedelta(days=1)))
    return (column >= low) & (column < high)


def yesterday(run_date: date) -> date:
    return run_date - timedelta(days=1)
