"""The stock jobs: operators put together, from landed documents to written table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.naming import snake_words
from tidemark.functions.timestamps import on_day, parse_catalogued, parse_timestamp, yesterday
from tidemark.operators.bookmarks import advance_bookmarks
from tidemark.operators.chunks import FATAL, backfill, landed_by_chunk, parse_range
from tidemark.operators.customfields import NO_VALUE, any_slot_in, channel_custom_fields, pivot_custom_fields
from tidemark.operators.diff import compare_keys
from tidemark.operators.documents import installment_table, installments_for, installments_known, product_configurations
from tidemark.operators.flatten import Leaf, flatten
from tidemark.operators.reconcile import ReconSpec, check_counts, partial_figures, reconcile, reconcile_parts, result_catalog, target_has_day
from tidemark.operators.repair import late_rows, repair_and_reconcile
from tidemark.operators.shape import add_meta
from tidemark.plans.catalog import TableCatalog, from_names, slot_catalog
from tidemark.plans.ingest import ingest, ingest_rows, parse_event, with_change_time
from tidemark.plans.staging import new_path, release, stage
from tidemark.sinks import keyed, ledger, tables
from tidemark.sinks.ledger import Settings
from tidemark.sources.landed import read_json_lines
from tidemark.sources.reads import distinct_keys


def backfill_ingest(
    spark: SparkSession, raw_event: Mapping, landed: DataFrame, target: str, run_ts: datetime, catalog: TableCatalog | None = None
) -> tuple[int, DataFrame | None]:
    """Ingest a long range in chunks of `chunk_hours` (24), one after another.

    Of a stream with a change field the landed records are read and parsed once, for all
    chunks; a chunk then reads its own rows only.  Records that cannot be read fail
    every chunk.  Returns the outcome code and the status of each chunk.  Chunks include
    both ends, so a row exactly on a boundary is appended twice.
    """
    try:
        start, end = parse_range(raw_event["start_date"], raw_event.get("end_date"), run_ts)
        hours = int(raw_event.get("chunk_hours", 24))
    except (KeyError, TypeError, ValueError):
        return FATAL, None
    path, landing = new_path(spark, "chunks"), {}

    def rows_of(number: int, cdc_field: str) -> DataFrame:
        if not landing:
            try:
                timed = with_change_time(landed, run_ts, cdc_field)
                landing["rows"] = landed_by_chunk(timed, cdc_field, start, end, hours, path)
            except Exception as failure:  # every chunk needs these rows
                landing["failure"] = failure
        if "failure" in landing:
            raise landing["failure"]
        return landing["rows"](number)

    def job(first: datetime, last: datetime) -> int:
        event = parse_event({**raw_event, "start_date": str(first), "end_date": str(last)}, run_ts)
        if event.request_type == "post" and event.cdc_field:
            number = (first - start) // timedelta(hours=hours) + 1
            return ingest_rows(spark, event, rows_of(number, event.cdc_field), target, run_ts, catalog).first().records_count
        return ingest(spark, event, landed, target, run_ts, catalog).first().records_count

    try:
        return backfill(spark, start, end, hours, job)
    finally:
        release(spark, path)


def ingest_next(
    spark: SparkSession, raw_event: Mapping, landed: DataFrame, target: str, run_ts: datetime, catalog: TableCatalog | None = None, settings: Settings | None = None
) -> DataFrame:
    """Ingest from where the table's last commit ends, and commit the new end with the rows.

    The start comes from the commit record, so no file of the lake is read for it.  A run
    that overlaps with another one is refused (`ledger.Behind`) and leaves nothing behind.
    The first run needs a `start_date`.  Returns one summary row.
    """
    cdc = snake_words(raw_event.get("cdc_field") or "")
    known = ledger.create(spark, target, settings or Settings(change=cdc or None))
    event = parse_event(raw_event, run_ts, mark=known.bookmark)
    return ingest(spark, event, landed, target, run_ts, catalog, lambda rows: ledger.commit(rows, target, after=known.number))


def stream_table(
    spark: SparkSession, folder: str, stream: str, run_ts: datetime, catalog: TableCatalog | None = None, **flatten_options
) -> DataFrame | None:
    """A stream's landed JSON lines, flattened and stamped with the run; None without files.

    Empty containers become ''.  Timestamps are parsed by catalog, or by column name.
    """
    lines = read_json_lines(spark, folder, stream)
    if lines is None:
        return None
    flat = add_meta(flatten(lines, "record", empty_as="", **flatten_options), run_ts)
    types = (catalog or from_names(flat.columns, {"date": "string"})).types
    return parse_catalogued(flat, types)


def load_streams(
    spark: SparkSession,
    folder: str,
    lake: str,
    streams: Iterable[str],
    run_ts: datetime,
    state: DataFrame,
    catalogs: dict[str, TableCatalog] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Replace today's partition of each stream that landed files; advance its bookmark.

    Returns the write status and the new bookmarks.
    """

    def job(stream: str) -> bool:
        batch = stream_table(spark, folder, stream, run_ts, (catalogs or {}).get(stream))
        if batch is None:
            return False
        tables.overwrite_partitions(batch, f"{lake}/{stream}")
        return True

    status = tables.write_streams(spark, [(stream, lambda s=stream: job(s)) for stream in streams])
    return status, advance_bookmarks(state, status)


def compare_stream(landed: DataFrame, lake: DataFrame, key: str) -> DataFrame:
    """Provenance of every key of a landed stream and its lake table, keys compared as text."""
    sides = [distinct_keys(df, key).withColumn(key, F.col(key).cast("string")) for df in (landed, lake)]
    return compare_keys(*sides, [key])


def reconcile_stream(
    spec: ReconSpec,
    source: DataFrame,
    read_target: Callable[[], DataFrame],
    results: str,
    run_ts: datetime,
    *,
    append_late: Callable[[DataFrame], None] | None = None,
    debug_root: str | None = None,
) -> tuple[str, DataFrame | None]:
    """Reconcile yesterday, keep the result rows, and check them.

    With `append_late` rows that came late are appended first (only streams compared by
    amount).  With `debug_root` the source rows of a day the lake falls short on are
    kept as CSV.  Returns the outcome and the checks (None without target rows).
    """
    target = read_target()
    if not target_has_day(spec, target, run_ts.date()):
        return "no_target_rows", None
    if append_late and spec.by_amount:
        recon, _ = repair_and_reconcile(spec, source, read_target, run_ts, append_late)
    else:
        recon = reconcile(spec, source, target, run_ts.date(), run_ts)
    # Kept and checked from one staged result, so that nothing is computed twice and no earlier day is read.
    recon = stage(recon, "recon")
    tables.append_csv(recon, results, result_catalog(spec))
    checks = check_counts(recon, spec)
    if debug_root and not checks.filter("target < source").isEmpty():
        tables.write_debug_snapshot(source, debug_root, spec.stream, "recon", run_ts)
    return ("match" if checks.filter("status <> 0").isEmpty() else "mismatch"), checks


def reconcile_table(
    spec: ReconSpec, source: DataFrame, target: str, run_ts: datetime, *, repair: bool = False
) -> tuple[str, DataFrame | None, DataFrame | None]:
    """Reconcile yesterday with a table that keeps its days and figures (`ledger.Settings`); with `repair`, commit late rows.

    The table's figures come from the parts its batches left.  Its rows are read only where
    the counts differ, and then only the keys of the partitions that hold rows of the day,
    wherever earlier repairs have put them.  The source is counted once, late rows are
    found once, and after a repair only the new batch has been read again.

    Returns the outcome, the checks and the late rows (None where there are none).
    """
    spark, day = source.sparkSession, yesterday(run_ts.date())
    if not ledger.day_partitions(spark, target, day):
        return "no_target_rows", None, None
    parts = stage(partial_figures(spec, source.filter(on_day(source, spec.day, day)), "source"), "source-parts")

    def checked() -> DataFrame:
        recon = reconcile_parts(spec, parts, ledger.figures(spark, target), run_ts.date(), run_ts)
        return stage(check_counts(recon, spec), "checks")

    checks, late = checked(), None
    if repair and spec.by_amount and not checks.filter("status <> 0").isEmpty():
        late = stage(late_rows(source, ledger.rows_of_day(spark, target, day), run_ts, key=spec.key, day_column=spec.day), "late")
        if late.isEmpty():
            late = None
        else:
            ledger.commit(late, target)
            checks = checked()
    return ("match" if checks.filter("status <> 0").isEmpty() else "mismatch"), checks, late


def refresh_installments(
    documents: DataFrame, accounts: DataFrame, target: str, run_ts: datetime, catalog: TableCatalog | None = None, registry: str | None = None
) -> DataFrame:
    """Installments of all accounts, replacing those loans' old rows; other loans stay.

    Loans lie in hash buckets, of which the touched ones are rewritten.  With `registry`,
    a folder, the leaf paths of earlier runs are used and kept.  Returns the rejected documents.
    """
    if registry:
        flat, rejects = installments_known(documents, accounts, registry, run_ts=run_ts)
    else:
        flat, rejects = installments_for(documents, accounts, run_ts=run_ts)
    keyed.replace_keys(installment_table(flat, catalog), target, "loan_account_id")
    return rejects


def refresh_products(documents: DataFrame, target: str, run_ts: datetime, catalog: TableCatalog | None = None, leaves: list[Leaf] | None = None) -> None:
    """Replace the product-configuration table; `leaves` are its paths where they are settled."""
    products = product_configurations(documents, run_ts=run_ts, leaves=leaves)
    types = (catalog or from_names(products.columns)).types
    tables.overwrite_table(parse_catalogued(products, types), target)


def extract_channel_fields(transactions: DataFrame, target: str, slots: int = 5, **filter_options) -> None:
    """Replace the table of card and transfer custom fields."""
    tables.overwrite_table(channel_custom_fields(transactions, slots, **filter_options), target, ("date",))


def pivot_table(
    accounts: DataFrame, ids: Sequence[str], target: str, run_ts: datetime, slots: int = 4, comments: dict[str, str] | None = None
) -> None:
    """Replace a pivoted custom-field table.

    Rows that hold one of `ids` in any slot are kept.  The catalogued columns are the
    ids asked for, so the pivot needs no look-up of the ids present.
    """
    rows = accounts.filter(any_slot_in(ids, slots))
    wide = pivot_custom_fields(rows, ids, slots=slots, run_date=f"{run_ts:%Y%m%d}")
    # The pivot fills every column; a filled creation date is none.
    created = parse_timestamp(F.nullif(F.col("creation_date"), F.lit(NO_VALUE)), "creation_date")
    wide = wide.withColumn("creation_date", created)
    tables.overwrite_table(wide.select(*slot_catalog(ids).types), target, ("date",), comments)
