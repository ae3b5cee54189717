"""Text cleaning and filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_text(column: Column | str) -> Column:
    """Line breaks and tabs become spaces, then pairs of spaces become one.

    The pair step is one left-to-right pass, so four spaces leave two.
    """
    column = F.col(column) if isinstance(column, str) else column
    return F.replace(F.translate(column, "\n\r\t", "   "), F.lit("  "), F.lit(" "))


# Stand-ins for an escaped backslash and an escaped quote; JSON text holds no such characters itself.
BACKSLASH, QUOTE = "\x01", "\x02"


def clean_json(text: Column) -> Column:
    """`clean_text` over all string values of compact JSON text; keys stay as they are.

    With escapes out of the way, what stands between quotes alternates between
    structure and strings, and a string that a colon follows is a key.
    """
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit(BACKSLASH)), F.lit('\\"'), F.lit(QUOTE))

    def cleaned(part: Column, at: Column, parts: Column) -> Column:
        value = part
        for escape in ("\\n", "\\r", "\\t"):
            value = F.replace(value, F.lit(escape), F.lit(" "))
        is_value = (at % 2 == 1) & ~F.startswith(F.coalesce(F.get(parts, at + 1), F.lit("")), F.lit(":"))
        # Text without quotes may be what stood between them.
        return F.when(is_value | (F.size(parts) == 1), F.replace(value, F.lit("  "), F.lit(" "))).otherwise(part)

    # The parts are an argument, not an expression: else each of them would have the text made and split anew.
    split = F.array(F.split(plain, '"', -1))
    whole = F.get(F.transform(split, lambda parts: F.array_join(F.transform(parts, lambda part, at: cleaned(part, at, parts)), '"')), 0)
    return F.replace(F.replace(whole, F.lit(QUOTE), F.lit('\\"')), F.lit(BACKSLASH), F.lit("\\\\"))


def clean_columns(df: DataFrame, *columns: str) -> DataFrame:
    """`clean_text` over the named columns, or over every text column."""
    names = columns or tuple(f.name for f in df.schema if isinstance(f.dataType, T.StringType))
    return df.withColumns({name: clean_text(F.col(name)) for name in names})


def fill_missing(df: DataFrame, filler: str = "0", markers: tuple[str, ...] = ("<NA>",)) -> DataFrame:
    """Every column as text, with nulls and missing-value markers replaced by `filler`."""
    def filled(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.when(text.isNull() | text.isin(*markers), F.lit(filler)).otherwise(text)

    return df.select(*[filled(name).alias(name) for name in df.columns])
