"""Coercing casts: what cannot be read becomes null or zero, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(column: Column, null_as_zero: bool = True) -> Column:
    text = column.cast("string")
    # Java also reads "1d" and "1f" as numbers.
    plain = F.when(~text.rlike(r"(?i)[0-9.][df]\s*$"), text)
    number = plain.try_cast("double")
    number = F.when(~F.isnan(number), number)
    return F.coalesce(number, F.lit(0.0)) if null_as_zero else number


def to_whole(column: Column, kind: str = "bigint", null_as_zero: bool = True) -> Column:
    """Whole numbers exactly; decimals lose their fraction; out of range counts as unreadable."""
    number = F.coalesce(
        column.cast("string").try_cast(kind), to_double(column, null_as_zero=False).try_cast(kind)
    )
    return F.coalesce(number, F.lit(0).cast(kind)) if null_as_zero else number


def to_boolean(column: Column) -> Column:
    return column.cast("string").try_cast("boolean")


def truthy(column: Column) -> Column:
    """Truthiness of text: null and the empty text are false, all other text is true."""
    return F.coalesce(F.length(column.cast("string")) > 0, F.lit(False))


def key_text(column: Column) -> Column:
    """A key as text; a missing key stays null, and the key joins match nulls."""
    return column.cast("string")


def key_number(column: Column) -> Column:
    """A key as a 64-bit number; text that is not a number is an error."""
    return column.cast("bigint")
