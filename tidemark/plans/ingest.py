"""The ingest pipelines: event in, rows appended, summary out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.naming import rename_in_order, snake_case, snake_words
from tidemark.functions.text import clean_json
from tidemark.operators.bookmarks import high_water_mark
from tidemark.operators.chunks import read_time
from tidemark.operators.digests import compare_days
from tidemark.operators.diff import BOTH, SOURCE_ONLY, TARGET_ONLY, compare_keys, keys_found
from tidemark.operators.flatten import Leaf, flatten
from tidemark.operators.shape import NESTED, add_meta, leftovers_as_text
from tidemark.operators.typing import apply_types, infer_types, profile_columns
from tidemark.plans.catalog import TableCatalog
from tidemark.plans.staging import new_path, release, restrict_to_keys, stage
from tidemark.sinks import tables
from tidemark.sources.landed import select_objects
from tidemark.sources.reads import distinct_keys, read_stream, read_table, whole_days

SUMMARY_SCHEMA = (
    "table_name string, endpoint string, cdc_field string, start_date string, end_date string, records_count bigint"
)


@dataclass(frozen=True)
class Event:
    """Parameters of one ingest run."""

    table_name: str
    endpoint: str
    request_type: str
    cdc_field: str = ""
    start_date: str | None = None
    end_date: str | None = None
    extra_params: str = ""  # for whoever lands the records
    auto_schema: bool = False
    rename_columns: tuple[Mapping[str, str], ...] = field(default_factory=tuple)

    @property
    def cdc_column(self) -> str:
        return snake_words(self.cdc_field)


def _utc(text: str) -> str:
    return read_time(text).replace(tzinfo=timezone.utc).isoformat()


def parse_event(raw: Mapping, now: datetime, lake: DataFrame | None = None, mark: str | None = None) -> Event:
    """Check and complete an event.

    The range starts where the event says, else at the lake's high-water mark when the
    stream has a change field; it ends where the event says, else now.  `mark` is that
    mark where the table's commits know it (`ledger.bookmark`); else the lake is read for it.
    """
    for key in ("endpoint", "table_name", "request_type"):
        if key not in raw:
            raise ValueError(f"event lacks {key}")
    cdc = raw.get("cdc_field") or ""
    start = raw.get("start_date")
    if start:
        start = _utc(start)
    elif cdc and mark:
        start = mark
    elif cdc:
        if lake is None:
            raise ValueError(f"{raw['table_name']} has no table to take the start from")
        start = high_water_mark(lake, cdc).first().bookmark
    end = _utc(raw["end_date"]) if raw.get("end_date") else now.replace(microsecond=0, tzinfo=timezone.utc).isoformat()
    return Event(
        raw["table_name"].lower(),
        raw["endpoint"],
        raw["request_type"].lower(),
        cdc,
        start or None,
        end,
        raw.get("extra_params", ""),
        str(raw.get("auto_schema", "False")).lower() == "true",
        tuple(raw.get("rename_columns") or ()),
    )


def process_response(
    df: DataFrame,
    document: str,
    *,
    keys: tuple[str, ...] = (),
    clean: bool = False,
    flat: bool = False,
    leaves: list[Leaf] | None = None,
) -> DataFrame:
    """Select objects, clean text, flatten (with embedded JSON text).

    Without `flat` the document stays one VARIANT column.
    """
    is_variant = dict(df.dtypes)[document] == "variant"
    value = F.col(document) if is_variant else F.parse_json(document)
    if flat:
        selected = df.withColumn(document, select_objects(value, keys)) if keys else df
        return flatten(selected, document, leaves, embedded=True, clean=clean)
    value = select_objects(value, keys)
    return df.withColumn(document, F.parse_json(clean_json(F.to_json(value))) if clean else value)


def process_records(
    df: DataFrame,
    run_ts: datetime,
    *,
    cdc_field: str = "",
    renames: tuple[Mapping[str, str], ...] = (),
    catalog: TableCatalog | None = None,
    **type_options,
) -> tuple[DataFrame, dict[str, str]]:
    """Meta columns, names, types, empty columns, leftovers; `catalog=None` infers the types.

    One aggregate over the batch serves both the inference and the search for empty
    columns.  Returns the frame and the types of its columns.
    """
    named = rename_in_order(snake_case(add_meta(df, run_ts, cdc_field or None)), renames)
    if catalog is None:
        profiles = profile_columns(named)
        types = infer_types(named, profiles)
        filled = {name for name, profile in profiles.items() if profile.values}
    else:
        types = catalog.types
        counts = named.agg(*[F.count(_stored(named, n, types)).alias(n) for n in named.columns]).first()
        filled = {name for name in named.columns if counts[name]}
    zeroed = {n for n, kind in types.items() if kind in ("int", "bigint", "double")} if type_options.get("null_as_zero", True) else set()
    keep = [name for name in named.columns if name in filled or name in zeroed]
    typed = apply_types(named.select(*keep), types, **type_options)
    return leftovers_as_text(typed, {n: k for n, k in types.items() if n in keep})


def _stored(df: DataFrame, name: str, types: Mapping[str, str]):
    """What counts as a value: empty text does not survive a timestamp column."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, NESTED) or types.get(name) not in ("timestamp", "date"):
        return column
    return F.nullif(column.cast("string"), F.lit(""))


def ingest(
    spark: SparkSession,
    event: Event,
    landed: DataFrame,
    target: str,
    run_ts: datetime,
    catalog: TableCatalog | None = None,
    write: Callable[[DataFrame], object] | None = None,
    iso_text: bool = False,
) -> DataFrame:
    """Read what the event asks for from the landed records, process it and append it.

    `landed` has the source's own (camelCase) columns.  An empty read writes nothing.
    `write` takes the processed rows; by default they are appended to `target`.
    `iso_text` says that a change field of text starts with yyyy-MM-dd: then a range of whole
    days around the one asked for reaches the scan, and only its rows are parsed.
    Returns one summary row.
    """
    if iso_text and event.cdc_field and event.start_date and isinstance(landed.schema[event.cdc_field].dataType, T.StringType):
        landed = landed.filter(whole_days(event.cdc_field, event.start_date, event.end_date))
    wanted = read_stream(
        with_change_time(landed, run_ts, event.cdc_field),
        event.endpoint,
        event.request_type,
        cdc=event.cdc_field or None,
        start=event.start_date,
        end=event.end_date,
        ordered=False,
    )
    return ingest_rows(spark, event, wanted, target, run_ts, catalog, write)


def with_change_time(landed: DataFrame, run_ts: datetime, cdc_field: str) -> DataFrame:
    """The change field, if there is one, parsed in place."""
    return add_meta(landed, run_ts, cdc_field).drop("date", "timestamp_extracted") if cdc_field else landed


def ingest_rows(
    spark: SparkSession,
    event: Event,
    wanted: DataFrame,
    target: str,
    run_ts: datetime,
    catalog: TableCatalog | None = None,
    write: Callable[[DataFrame], object] | None = None,
) -> DataFrame:
    """Process and append rows that are all wanted; one summary row."""
    write = write or (lambda rows: tables.append(rows, target))
    # Staged, so that the landed files are read and parsed once: looking for empty
    # columns and writing each read the batch again.
    path, count = new_path(spark, "batch"), 0
    try:
        batch = stage(wanted, path=path)
        if not batch.isEmpty():
            shaped, _ = process_records(
                batch,
                run_ts,
                cdc_field=event.cdc_field,
                renames=event.rename_columns,
                catalog=None if event.auto_schema else catalog,
            )
            # Counted while it is written, not in a second pass.
            written = Observation()
            write(shaped.observe(written, F.count(F.lit(1)).alias("n")))
            count = written.get["n"]
    finally:
        release(spark, path)
    summary = (event.table_name, event.endpoint, event.cdc_field, event.start_date, event.end_date, count)
    return spark.createDataFrame([summary], SUMMARY_SCHEMA)


@dataclass(frozen=True)
class Backfill:
    """Outcome of a three-way comparison."""

    not_in_lake: DataFrame
    not_in_source: DataFrame
    in_both: DataFrame
    to_backfill: DataFrame
    applied: bool


def three_way_backfill(
    source: DataFrame,
    target: str,
    key: str,
    run_ts: datetime,
    *,
    apply: bool = False,
    reports: str | None = None,
    day: str | None = None,
    target_day: str | None = None,
) -> Backfill:
    """Compare keys as text, report both differences, and append what the lake lacks.

    `apply=False` is a dry run.  `reports` is a folder for the difference reports.  With `day`
    (and `target_day`, where the lake calls it otherwise) only days and buckets of
    keys whose digests differ are compared key by key (see `compare_days`).
    """
    spark = source.sparkSession
    # Only the key is read, which every file has: no need to merge file schemas.
    stored = read_table(spark, target, merge=False)
    texts = stored.withColumn(key, F.col(key).cast("string"))
    texts = texts.select(key, target_day or day) if day else distinct_keys(texts, key)
    rows = source.withColumn(key, F.col(key).cast("string"))
    # Staged once: four results are taken from it.  With a day to go by, digests say where keys need to be compared.
    compared = stage(compare_days(rows, texts, [key], day, target_day) if day else compare_keys(rows, texts, [key]), "compared")
    missing, extra = keys_found(compared, SOURCE_ONLY), keys_found(compared, TARGET_ONLY)
    to_backfill = restrict_to_keys(rows, missing, [key], null_safe=True)
    if reports:
        tables.write_report(missing, f"{reports}/not_in_data_lake")
        tables.write_report(extra, f"{reports}/not_in_source")
        tables.write_report(rows, f"{reports}/source")
    if apply and not to_backfill.isEmpty():
        tables.append(add_meta(to_backfill, run_ts), target)
    return Backfill(missing, extra, keys_found(compared, BOTH), to_backfill, apply)
