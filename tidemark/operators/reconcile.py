"""Daily reconciliation of a source extract against the lake."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.timestamps import calendar_day, day_text, on_day, yesterday
from tidemark.operators.shape import run_time
from tidemark.plans.catalog import TableCatalog

MONEY = "decimal(20,2)"
ROWS = "total_rowcount_for_date"


@dataclass(frozen=True)
class ReconSpec:
    """How one stream is compared.

    day:         source column whose day is compared; None takes the day before the run.
    target_day:  the target's column, where it differs.
    key, label:  what is counted distinct, and what the result columns call it.
    by_amount:   compare per (day, currency, type) with amounts and id extremes instead.
    check:       the figures `check_counts` compares.
    day_is_partition: the target's `date` partition is the day compared, so it can prune;
                 not for tables with repaired rows, which lie in the day of the repair.
    """

    stream: str
    day: str | None
    key: str = "id"
    label: str = ""
    target_day: str | None = None
    by_amount: bool = False
    check: tuple[str, ...] = ()
    day_is_partition: bool = False

    @property
    def figures(self) -> tuple[str, ...]:
        return (ROWS, f"total_{self.label}_for_date")


def _spec(stream: str, day: str | None, key: str = "id", **options) -> ReconSpec:
    return ReconSpec(stream, day, key, stream, check=(f"total_{stream}_for_date",), **options)


# The streams and the columns they are compared by.
SPECS = {
    spec.stream: spec
    for spec in (
        ReconSpec("deposit_transactions", "creation_date", by_amount=True, check=(ROWS,)),
        ReconSpec("gl_journal_entries", "creation_date", "entry_id", "gl_journal_entries", check=(ROWS,)),
        _spec("clients", "last_modified_date"),
        _spec("deposit_accounts", "creation_date"),
        _spec("gl_accounts", None, "gl_code", target_day="timestamp_extracted"),
        _spec("users", "last_modified_date"),
        _spec("loan_accounts", "last_modified_date"),
        _spec("loan_transactions", "creation_date"),
        _spec("loan_products", "creation_date"),
    )
}


def result_catalog(spec: ReconSpec) -> TableCatalog:
    """Columns and types of the stored reconciliation table."""
    if spec.by_amount:
        types = {
            "reconciliation_date": "date",
            "currency_code": "string",
            "type": "string",
            **{
                f"{side}_{figure}": kind
                for side in ("source", "target")
                for figure, kind in (
                    ("min_id_for_date", "bigint"),
                    ("max_id_for_date", "bigint"),
                    ("currency_type_transactions_total_for_date", "int"),
                    ("sum_amount_for_currency_and_date", MONEY),
                    (ROWS, "int"),
                )
            },
        }
    else:
        types = {
            "reconciliation_date": "date",
            **{f"{side}_{figure}": "int" for side in ("source", "target") for figure in spec.figures},
        }
    return TableCatalog({**types, "timestamp_extracted": "timestamp"})


def _days(df: DataFrame, column: str | None, day: date | None, fixed: date | None) -> tuple[DataFrame, Column]:
    """The rows to compare and the day each belongs to."""
    if column is None:
        return df, F.lit(fixed)
    # The day filter is on the stored column, so it is evaluated by the scan.
    rows = df.filter(on_day(df, column, day)) if day else df.filter(F.col(column).isNotNull())
    return rows, calendar_day(df, column)


def _key_counts(df: DataFrame, day: Column, key: str) -> DataFrame:
    return df.groupBy(day.alias("day"), F.col(key).alias("key")).agg(F.count("*").alias("n"))


def _day_counts(per_key: DataFrame) -> DataFrame:
    return per_key.groupBy("day").agg(F.sum("n").alias("rows"), F.count("key").alias("keys"))


def daily_counts(df: DataFrame, day: Column, key: str) -> DataFrame:
    """Rows and exact distinct keys per day.

    Grouping by (day, key) first spreads a day that holds much of the data over all
    tasks; repeated keys collapse before the shuffle.
    """
    return _day_counts(_key_counts(df, day, key))


def _amount_groups(df: DataFrame, day: Column, id_column="id", currency="currency_code", kind="type", amount="amount") -> DataFrame:
    number = F.col(id_column).cast("bigint")
    return df.groupBy(day.alias("day"), F.col(currency).alias("currency_code"), F.col(kind).alias("type")).agg(
        F.min(number).alias("low"),
        F.max(number).alias("high"),
        F.count("*").alias("n"),
        F.sum(F.col(amount).cast(MONEY)).cast(MONEY).alias("amount"),
    )


def _day_amounts(groups: DataFrame) -> DataFrame:
    over_day = W.partitionBy("day")
    return groups.select(
        "day",
        "currency_code",
        "type",
        F.min("low").over(over_day).alias("min_id_for_date"),
        F.max("high").over(over_day).alias("max_id_for_date"),
        F.col("n").alias("currency_type_transactions_total_for_date"),
        F.col("amount").alias("sum_amount_for_currency_and_date"),
        F.sum("n").over(over_day).alias(ROWS),
    )


def daily_amounts(df: DataFrame, day: Column, *, id_column="id", currency="currency_code", kind="type", amount="amount") -> DataFrame:
    """Counts and decimal sums per (day, currency, type) with the day's totals on each row.

    One scan: the day's figures are windows over the grouped rows, of which a day has
    one per currency and type.
    """
    return _day_amounts(_amount_groups(df, day, id_column, currency, kind, amount))


def partial_figures(spec: ReconSpec, rows: DataFrame, side: str = "target") -> DataFrame:
    """What one batch of a stream adds to its daily figures; parts of several batches can be merged.

    Streams compared by amount have a row per (day, currency, type); the others one per
    (day, key), since distinct keys of two batches cannot be added up.
    """
    column = spec.day if side == "source" else spec.target_day or spec.day
    if column is None:
        raise ValueError(f"{spec.stream} is compared by run date: its {side} has no day to keep figures by")
    dated, day = _days(rows, column, None, None)
    return _amount_groups(dated, day) if spec.by_amount else _key_counts(dated, day, spec.key)


def merged_parts(spec: ReconSpec, parts: DataFrame) -> DataFrame:
    """The parts of several batches as those of one."""
    if not spec.by_amount:
        return parts.groupBy("day", "key").agg(F.sum("n").alias("n"))
    return parts.groupBy("day", "currency_code", "type").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.sum("amount").cast(MONEY).alias("amount")
    )


def merged_figures(spec: ReconSpec, parts: DataFrame) -> DataFrame:
    """The daily figures of all batches whose parts are given, as if their rows were counted together."""
    whole = merged_parts(spec, parts)
    return _day_amounts(whole) if spec.by_amount else _day_counts(whole)


def _prefixed(df: DataFrame, side: str, grain: list[str]) -> DataFrame:
    return df.select(*grain, *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c not in grain])


def reconcile(
    spec: ReconSpec,
    source: DataFrame,
    target: DataFrame,
    run_date: date | None = None,
    run_ts: datetime | None = None,
    how: str = "inner",
) -> DataFrame:
    """Source and target figures side by side, one row per day (and currency and type).

    With `run_date` only the day before it is compared, else every day.  The inner
    join leaves out days one side lacks; `how="left"` or `"full"` shows them.
    """
    day = yesterday(run_date) if run_date else None
    if spec.day is None and day is None:
        raise ValueError(f"{spec.stream} is compared by run date")
    sides = []
    for side, df, column in (("source", source, spec.day), ("target", target, spec.target_day or spec.day)):
        if side == "target" and day and spec.day_is_partition:
            df = df.filter(F.col("date") == day_text(F.lit(day)))
        rows, day_of_row = _days(df, column, day, day)
        sides.append(daily_amounts(rows, day_of_row) if spec.by_amount else daily_counts(rows, day_of_row, spec.key))
    return _side_by_side(spec, *sides, run_ts, how)


def _side_by_side(spec: ReconSpec, source: DataFrame, target: DataFrame, run_ts: datetime | None, how: str) -> DataFrame:
    grain = ["day", "currency_code", "type"] if spec.by_amount else ["day"]
    sides = []
    for side, figures in (("source", source), ("target", target)):
        if not spec.by_amount:
            figures = figures.select("day", F.col("rows").alias(ROWS), F.col("keys").alias(f"total_{spec.label}_for_date"))
        sides.append(_prefixed(figures, side, grain))
    # Both sides are already grouped and placed by the day.
    result = sides[0].join(sides[1], grain, how).withColumnRenamed("day", "reconciliation_date")
    return result.withColumn("timestamp_extracted", run_time(run_ts)) if run_ts else result


def reconcile_parts(
    spec: ReconSpec,
    source_parts: DataFrame,
    target_parts: DataFrame,
    run_date: date | None = None,
    run_ts: datetime | None = None,
    how: str = "inner",
) -> DataFrame:
    """`reconcile` from the parts that batches have left (`partial_figures`), without their rows.

    A target that keeps its parts is not scanned: only rows that are new since the
    last run have ever been read for them.
    """
    if run_date:
        at = F.col("day") == F.lit(yesterday(run_date))
        source_parts, target_parts = source_parts.filter(at), target_parts.filter(at)
    return _side_by_side(spec, merged_figures(spec, source_parts), merged_figures(spec, target_parts), run_ts, how)


def target_has_day(spec: ReconSpec, target: DataFrame, run_date: date) -> bool:
    """Whether the lake holds anything for the day before the run."""
    column = spec.target_day or spec.day
    return not target.filter(on_day(target, column, yesterday(run_date))).isEmpty()


def check_counts(recon: DataFrame, spec: ReconSpec, first_only: bool = False) -> DataFrame:
    """Per day and figure: source, target and status, 0 when equal and -1 when not.

    Days are compared by the mean of a figure, which repeats on each row of a day.
    `first_only` keeps only the earliest day and the first figure.
    """
    checks = spec.check[:1] if first_only else spec.check
    means = [F.avg(f"{side}_{c}").alias(f"{side}_{c}") for c in checks for side in ("source", "target")]
    daily = recon.groupBy("reconciliation_date").agg(*means)
    if first_only:
        earliest = recon.agg(F.min("reconciliation_date")).scalar()
        daily = daily.filter(F.col("reconciliation_date") == earliest)
    figures = F.array(
        *[
            F.struct(
                F.lit(c).alias("figure"), F.col(f"source_{c}").alias("source"), F.col(f"target_{c}").alias("target")
            )
            for c in checks
        ]
    )
    equal = F.col("source").eqNullSafe(F.col("target"))
    return daily.select("reconciliation_date", F.inline(figures)).select(
        F.lit(spec.stream).alias("stream"),
        "reconciliation_date",
        "figure",
        "source",
        "target",
        F.when(equal, 0).otherwise(-1).alias("status"),
    )


def reconcile_outcome(spec: ReconSpec, recon: DataFrame, target_rows: int) -> str:
    """`no_target_rows` when there is nothing to compare with, else `match` or `mismatch`."""
    if target_rows == 0:
        return "no_target_rows"
    return "match" if check_counts(recon, spec).filter("status <> 0").isEmpty() else "mismatch"


def rows_per_day(df: DataFrame, column: str, day: date | None = None) -> DataFrame:
    """Row count per day of a column, latest day first."""
    rows = df.filter(on_day(df, column, day)) if day else df
    return (
        rows.groupBy(calendar_day(df, column).alias(column)).agg(F.count("*").alias("total_count")).orderBy(F.desc(column))
    )


def keys_of_day(df: DataFrame, column: str, key: str, day: date) -> DataFrame:
    """The distinct (day, key) pairs of one day."""
    return df.filter(on_day(df, column, day)).select(calendar_day(df, column).alias(column), key).distinct()


def extremes(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"))


def distinct_count(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.countDistinct(key).alias("distinct_keys"), F.count("*").alias("total_rows"))
