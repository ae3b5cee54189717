"""Column naming rules.  Names are metadata, so these run on the driver; the
column forms exist for names that arrive as data."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where a word starts inside a camelCase name.
WORD_BOUNDARY = r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])"
CAPITAL = r"(?=[A-Z])"


def snake_words(name: str) -> str:
    """Split at words, keeping acronyms whole: `accountIBANCode` -> `account_iban_code`."""
    return re.sub(r"_+", "_", re.sub(WORD_BOUNDARY, "_", name)).strip("_").lower()


def snake_letters(name: str) -> str:
    """Split before every capital: `IBAN` -> `i_b_a_n`."""
    return re.sub(CAPITAL, "_", name).lower().lstrip("_")


def snake_words_column(column: Column) -> Column:
    """`snake_words` for names held in a column."""
    split = F.regexp_replace(column, WORD_BOUNDARY, "_")
    return F.lower(F.btrim(F.regexp_replace(split, "_+", "_"), F.lit("_")))


def snake_letters_column(column: Column) -> Column:
    """`snake_letters` for names held in a column."""
    return F.regexp_replace(F.lower(F.regexp_replace(column, CAPITAL, "_")), "^_+", "")


def snake_case(df: DataFrame, rule: Callable[[str], str] = snake_words) -> DataFrame:
    """Rename every column by `rule`; two columns may not end up with one name."""
    names = [rule(name) for name in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns share a name after renaming: {clashes}")
    return df.toDF(*names)


def rename_in_order(df: DataFrame, renames: Iterable[Mapping[str, str]]) -> DataFrame:
    """Apply rename maps one after another; absent columns are ignored."""
    for mapping in renames:
        df = df.withColumnsRenamed(dict(mapping))
    return df
