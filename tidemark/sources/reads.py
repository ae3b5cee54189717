"""Full, categorised and incremental reads of a stream."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timestamps import try_parse_timestamp
from tidemark.sinks import keyed, ledger, schemas

# The categories a full read asks for one after another.
LEDGER_TYPES = ("ASSET", "LIABILITY", "EQUITY", "INCOME", "EXPENSE")
LOAN_STATES = (
    "PARTIAL_APPLICATION",
    "PENDING_APPROVAL",
    "APPROVED",
    "ACTIVE",
    "ACTIVE_IN_ARREARS",
    "CLOSED",
    "CLOSED_WRITTEN_OFF",
    "CLOSED_REJECTED",
)
DUE_FROM, DUE_TO = date(2022, 1, 1), date(2122, 1, 1)
# The one endpoint whose change reads are not ordered.
UNSORTED_ENDPOINTS = ("creditarrangements:search",)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames; a column a frame lacks is null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def ledger_accounts(df: DataFrame, end: date, category: str = "type", types: tuple[str, ...] = LEDGER_TYPES) -> DataFrame:
    """Ledger accounts of the known types, stamped with the day their balance refers to.

    The categories are one predicate on one scan, not one read each.
    """
    return df.filter(F.col(category).isin(*types)).withColumn(
        "balance_to_date", F.lit(end - timedelta(days=1))
    )


def loan_installments(
    df: DataFrame, state: str = "account_state", due: str = "due_date", states: tuple[str, ...] = LOAN_STATES
) -> DataFrame:
    """Installments of accounts in the known states, due inside the reporting range."""
    low, high = (F.lit(d.isoformat()).cast(df.schema[due].dataType) for d in (DUE_FROM, DUE_TO))
    return df.filter(F.col(state).isin(*states) & F.col(due).between(low, high))


def bound(df: DataFrame, name: str, value: datetime | str) -> Column:
    """A range end as a literal of the column's own type, so that the comparison is pushed down."""
    text = value if isinstance(value, str) else value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text).cast(df.schema[name].dataType)


def whole_days(cdc: str, start: datetime | str, end: datetime | str) -> Column:
    """ISO text of the days around a range, wide enough for any offset, as a comparison of the stored text."""
    first, last = (datetime.fromisoformat(v) if isinstance(v, str) else v for v in (start, end))
    return (F.col(cdc) >= (first.date() - timedelta(days=2)).isoformat()) & (F.col(cdc) < (last.date() + timedelta(days=3)).isoformat())


def cdc_range(
    df: DataFrame,
    cdc: str,
    start: datetime | str,
    end: datetime | str,
    *,
    ordered: bool = True,
    half_open: bool = False,
    iso_text: bool = False,
) -> DataFrame:
    """Changes between two instants, both included, in the order they happened.

    `half_open` leaves out the end, so that consecutive ranges share no row.  Text is
    compared and ordered by the instant it names; text that names none is in no
    range.  `iso_text` says that all of it starts with yyyy-MM-dd: then a range of
    whole days, wide enough for any offset, reaches the scan as well.
    """
    if not isinstance(df.schema[cdc].dataType, T.StringType):
        at, low, high = F.col(cdc), bound(df, cdc, start), bound(df, cdc, end)
    else:
        at = try_parse_timestamp(F.col(cdc))
        low, high = (F.lit(v if isinstance(v, str) else v.isoformat(" ")).cast("timestamp") for v in (start, end))
        if iso_text:
            df = df.filter(whole_days(cdc, start, end))
    inside = (at >= low) & ((at < high) if half_open else (at <= high))
    rows = df.filter(inside)
    return rows.orderBy(at) if ordered else rows


def read_stream(
    df: DataFrame,
    endpoint: str,
    request_type: str,
    *,
    cdc: str | None = None,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Dispatch on the kind of request: `get` reads in full, `post` reads changes.

    `ordered=False` leaves out the sort by change time, for rows that are only written on.
    """
    if request_type == "get":
        if endpoint == "glaccounts":
            last = end if isinstance(end, str) else end.isoformat()
            return ledger_accounts(df, date.fromisoformat(last[:10]))
        if endpoint == "installments":
            return loan_installments(df)
        return df
    if request_type == "post":
        if not cdc:
            raise ValueError("a change read needs the change field")
        return cdc_range(df, cdc, start, end, ordered=ordered and endpoint not in UNSORTED_ENDPOINTS)
    raise ValueError(f"request type {request_type!r} is neither get nor post")


def rows_with(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose column holds one of a few given values."""
    return df.filter(F.col(column).isin(*values))


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def read_table(spark: SparkSession, name_or_path: str, schema: T.StructType | None = None, merge: bool = True) -> DataFrame:
    """A lake table by catalog name or by path.

    A table by path that the library has written keeps its schema beside it, and one
    that is written batch by batch shows what is committed.  Of others, files of
    different ages are merged by column, which reads every file's footer; give the
    schema, or `merge=False` for columns all files have, to avoid it.
    """
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    if ledger.is_ledger(spark, name_or_path):
        return ledger.read(spark, name_or_path)
    if keyed.is_keyed(spark, name_or_path):
        return keyed.read_keyed(spark, name_or_path)
    schema = schema or schemas.logged_schema(spark, name_or_path)
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", str(merge).lower())
    return reader.parquet(name_or_path)


def run_sql(spark: SparkSession, text: str, **args) -> DataFrame:
    """A query with named parameters (`:run_date`) bound as values, never spliced into the text."""
    return spark.sql(text, args=args) if args else spark.sql(text)


def run_sql_file(spark: SparkSession, path: str, **args) -> DataFrame:
    return run_sql(spark, spark.read.text(path, wholetext=True).first()[0], **args)


