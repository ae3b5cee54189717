"""Column types: inferring them from values, and applying them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.coerce import to_boolean, to_double, to_whole, truthy
from tidemark.functions.timestamps import parse_timestamp_column, try_parse_timestamp

# Texts that count as missing when types are inferred.
NULL_LIKE = ("None", "")
# Literals as they are written in the source: 7, -1_000, 1.5, .5, 2e3, true, False.
WHOLE = r"^\s*[+-]?(0[0_]*|[1-9][0-9_]*)\s*$"
DECIMAL = r"^\s*[+-]?(([0-9][0-9_]*\.[0-9_]*|\.[0-9][0-9_]*)([eE][+-]?[0-9]+)?|[0-9][0-9_]*[eE][+-]?[0-9]+)\s*$"
TRUTH = r"(?i)^\s*(true|false)\s*$"

# What one value looks like, as bits so that a column is summarised by one `bit_or`.
INT, FLOAT, BOOL, DAY, INSTANT, OTHER = 1, 2, 4, 8, 16, 32


@dataclass(frozen=True)
class ColumnProfile:
    """What the values of one column look like."""

    kinds: int
    low: int | None
    high: int | None
    values: int


DAY_MICROS = 86_400_000_000


def _temporal(moment: Column) -> Column:
    """DAY at midnight, INSTANT otherwise, null for null; written to use `moment` once."""
    midnight = (F.unix_micros(moment) % DAY_MICROS == 0).cast("int")
    return F.lit(INSTANT) - midnight * (INSTANT - DAY)


def _kind(text: Column, literals: bool) -> Column:
    temporal = F.coalesce(_temporal(try_parse_timestamp(text)), F.lit(OTHER))
    if not literals:
        return temporal
    return (
        F.when(text.rlike(WHOLE), INT).when(text.rlike(DECIMAL), FLOAT).when(text.rlike(TRUTH), BOOL).otherwise(temporal)
    )


def _typed_kind(raw: Column, kind: T.DataType) -> Column:
    """What a value of a typed column looks like, without reading its text."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return _temporal(raw.cast("timestamp"))
    bits = {T.IntegralType: INT, T.FractionalType: FLOAT, T.BooleanType: BOOL}
    return F.when(raw.isNotNull(), next((bit for base, bit in bits.items() if isinstance(kind, base)), OTHER))


def profile_columns(df: DataFrame) -> dict[str, ColumnProfile]:
    """One aggregate over the batch, four figures per column.

    The steps are separate projections so that a value is prepared, classified and
    read as a number once each.
    """
    fields = list(enumerate(df.schema))
    is_text = {i: isinstance(f.dataType, T.StringType) for i, f in fields}
    prepared, classified, numbers = [], [], []
    for i, field in fields:
        raw, value = F.col(field.name), F.col(f"v{i}")
        prepared += [
            (F.when(~raw.isin(*NULL_LIKE), raw) if is_text[i] else raw).alias(f"v{i}"),
            raw.isNotNull().alias(f"n{i}"),
        ]
        kind = _kind(value, field.name.lower() != "date") if is_text[i] else _typed_kind(value, field.dataType)
        classified += [value, F.col(f"n{i}"), F.when(value.isNotNull(), kind).alias(f"k{i}")]
        if is_text[i] or isinstance(field.dataType, T.IntegralType):
            digits = F.replace(F.btrim(value), F.lit("_")) if is_text[i] else value
            whole = F.when(F.col(f"k{i}") == INT, digits.try_cast("decimal(38,0)"))
        else:
            whole = F.lit(None).cast("decimal(38,0)")
        numbers += [whole.alias(f"w{i}"), F.col(f"n{i}"), F.col(f"k{i}")]
    figures = [
        figure
        for i, _ in fields
        for figure in (
            F.bit_or(f"k{i}").alias(f"k{i}"),
            F.min(f"w{i}").alias(f"l{i}"),
            F.max(f"w{i}").alias(f"h{i}"),
            F.count_if(f"n{i}").alias(f"n{i}"),
        )
    ]
    row = df.select(*prepared).select(*classified).select(*numbers).agg(*figures).first()
    return {
        name: ColumnProfile(row[f"k{i}"] or 0, row[f"l{i}"], row[f"h{i}"], row[f"n{i}"])
        for i, name in enumerate(df.columns)
    }


def type_from_profile(name: str, profile: ColumnProfile) -> str:
    kinds = profile.kinds
    if name == "date" or kinds == 0 or kinds & OTHER:
        return "string"
    if kinds == INT:
        # Both ends decide: a very negative minimum needs 64 bits too.
        if -(2**31) <= profile.low and profile.high < 2**31:
            return "int"
        return "bigint" if -(2**63) <= profile.low and profile.high < 2**63 else "string"
    if kinds in (FLOAT, INT | FLOAT):
        return "double"
    if kinds == BOOL:
        return "boolean"
    if kinds == DAY:
        return "date"
    return "timestamp" if not kinds & (INT | FLOAT | BOOL) else "string"


def infer_types(df: DataFrame, profiles: dict[str, ColumnProfile] | None = None) -> dict[str, str]:
    """The type of each column, judged by all its values."""
    profiles = profiles or profile_columns(df)
    return {name: type_from_profile(name, profiles[name]) for name in df.columns}


def apply_types(
    df: DataFrame,
    types: dict[str, str],
    *,
    null_as_zero: bool = True,
    truthy_booleans: bool = False,
    strict_timestamps: bool = True,
) -> DataFrame:
    """Cast the columns that `types` lists; columns it does not list stay as they are.

    Numbers that are missing or unreadable become zero.  `truthy_booleans` treats
    any non-empty text as true, `"false"` included, instead of reading it.
    """

    def typed(name: str, kind: str) -> Column:
        column = F.col(name)
        if kind in ("timestamp", "date") and name != "date":
            moment = parse_timestamp_column(df, name, strict_timestamps)
            return moment if kind == "timestamp" else moment.cast("date")
        if kind in ("int", "bigint"):
            return to_whole(column, kind, null_as_zero)
        if kind == "double":
            return to_double(column, null_as_zero)
        if kind == "boolean":
            return truthy(column) if truthy_booleans else to_boolean(column)
        return column.cast(kind)

    wanted = {name: typed(name, kind) for name, kind in types.items() if name in df.columns}
    return df.withColumns(wanted) if wanted else df


def boolean_or_text(df: DataFrame, types: dict[str, str], prefix: str = "access") -> DataFrame:
    """Columns catalogued as boolean, and uncatalogued ones named `prefix...`: boolean when
    every value reads as one, else text."""
    wanted = [
        name
        for name in df.columns
        if types.get(name) == "boolean" or (name not in types and name.startswith(prefix))
    ]
    if not wanted:
        return df
    bad = [
        F.count(F.when(F.col(c).isNotNull() & to_boolean(F.col(c)).isNull(), 1)).alias(c) for c in wanted
    ]
    unreadable = df.agg(*bad).first()
    return df.withColumns(
        {c: F.col(c).cast("string") if unreadable[c] else to_boolean(F.col(c)) for c in wanted}
    )
