"""Tables over several runs: streams and repairs together, reconciliation from what commits keep, replaced keys."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators.digests import compare_days, differences
from tidemark.operators.documents import installment_table, installments_known
from tidemark.operators.flatten import flatten
from tidemark.operators.reconcile import SPECS, partial_figures, reconcile, reconcile_parts
from tidemark.plans.catalog import TableCatalog, create_database
from tidemark.plans.ingest import process_records, process_response
from tidemark.plans.jobs import (
    backfill_ingest,
    extract_channel_fields,
    ingest_next,
    pivot_table,
    reconcile_stream,
    reconcile_table,
    refresh_installments,
    refresh_products,
)
from tidemark.plans.staging import new_path
from tidemark.queries.fields import CHANNEL_ROWS, SLOTS, _card_events, _slots
from tidemark.queries.ingesting import WEEK, WEEK_PLAN, _range
from tidemark.queries.reconciling import BY_AMOUNT_SQL
from tidemark.queries.registry import EVENTS_MISSING, ORDERS_MISSING, events, lake_events, lake_transactions, query, stamp, table, transactions
from tidemark.queries.shaping import _schedule_documents
from tidemark.sinks import ledger
from tidemark.sinks.ledger import Settings
from tidemark.sinks.tables import append
from tidemark.sources.landed import select_objects
from tidemark.sources.pages import page_slice
from tidemark.sources.reads import read_table
from tidemark.streaming.incremental import append_available, ingest_available, landed_lines, landed_stream, with_day

RUN_TS = datetime(2024, 2, 1, 1, 0)
ACCOUNTS, AMOUNTS = SPECS["deposit_accounts"], SPECS["deposit_transactions"]


@query(
    "incremental_then_repair",
    """
SELECT strftime(ts, '%Y%m%d') AS date, event_type, COUNT(*) AS n, COUNT(DISTINCT event_id) AS keys,
       CAST(SUM(CAST(value AS DECIMAL(20,2))) AS DECIMAL(20,2)) AS total FROM events GROUP BY 1, 2
""",
)
def incremental_then_repair(spark, sf_dir):
    """A stream, a repair by batch with values as text, the stream again, and a batch of it replayed: every row is there once."""
    root = new_path(spark, "shared-table")
    drop, lake, checkpoint = f"{root}/landed", f"{root}/lake", f"{root}/checkpoint"
    rows = events(spark, sf_dir).select("event_id", "event_type", "ts", "value")

    def stream(part):
        rows.filter(part).write.mode("append").json(drop)
        landed = landed_stream(spark, drop, "event_id bigint, event_type string, ts timestamp, value double")
        append_available(landed, lake, checkpoint, lambda df: with_day(df, "ts"), writer="events")

    stream("event_type IN ('view', 'click')")
    missed = with_day(rows.filter("event_type = 'error'"), "ts")
    append(missed.withColumns({"value": F.col("value").cast("string"), "ts": F.col("ts").cast("string")}), lake)
    stream("event_type NOT IN ('view', 'click', 'error')")
    ledger.commit(with_day(rows, "ts"), lake, "events", 1)
    return read_table(spark, lake).groupBy("date", "event_type").agg(
        F.count("*").alias("n"),
        F.countDistinct("event_id").alias("keys"),
        F.sum(F.col("value").cast("decimal(20,2)")).cast("decimal(20,2)").alias("total"),
    )


@query(
    "ingest_available_records",
    """
SELECT strftime(ts, '%Y%m%d') AS date, COUNT(*) AS n, COUNT(DISTINCT event_id) AS keys, COUNT(*) FILTER (event_type = 'error') AS tagged,
       CAST(SUM(CAST(value AS DECIMAL(20,2))) AS DECIMAL(20,2)) AS total FROM events GROUP BY 1
""",
)
def ingest_available_records(spark, sf_dir):
    """Landed JSON text to a typed table in two runs and an idle one; the second drop brings paths the first has not."""
    root = new_path(spark, "records-stream")
    drop, lake, checkpoint, registry = (f"{root}/{n}" for n in ("landed", "lake", "checkpoint", "leaves"))
    record = F.struct(
        F.col("event_id").alias("eventId"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("creationDate"),
        F.struct(F.col("value").alias("amount")).alias("detail"),
        F.when(F.col("event_type") == "error", F.array(F.struct(F.col("event_type").alias("name")))).alias("tags"),
    )
    types = TableCatalog({"event_id": "bigint", "creation_date": "timestamp", "detail_amount": "double", "tags_0_name": "string"})
    for part in ("event_type <> 'error'", "event_type = 'error'", "false"):
        events(spark, sf_dir).filter(part).select(F.to_json(record).alias("value")).write.mode("append").text(drop)
        ingest_available(landed_lines(spark, drop), lake, checkpoint, registry, RUN_TS, cdc_field="creationDate", catalog=types)
    return read_table(spark, lake).groupBy("date").agg(
        F.count("*").alias("n"),
        F.countDistinct("event_id").alias("keys"),
        F.count("tags_0_name").alias("tagged"),
        F.sum(F.col("detail_amount").cast("decimal(20,2)")).cast("decimal(20,2)").alias("total"),
    )


@query(
    "append_typed_roundtrip",
    """
SELECT o_orderkey AS id, CAST(o_totalprice AS DECIMAL(20,2)) AS amount, CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey % 7 AS INTEGER) END AS level,
       strftime(o_orderdate, '%Y%m') AS date
FROM orders
""",
)
def append_typed_roundtrip(spark, sf_dir):
    """Three batches: the second brings a column, the third has text for all, and takes the types of both."""
    lake = new_path(spark, "typed")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderstatus",
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").cast("decimal(20,2)").alias("amount"),
        (F.col("o_custkey") % 7).cast("int").alias("level"),
        F.date_format("o_orderdate", "yyyyMM").alias("date"),
    )
    first = rows.filter("o_orderstatus = 'F'").drop("o_orderstatus", "level")
    append(first, lake)
    append(rows.filter("o_orderstatus = 'O'").drop("o_orderstatus"), lake)
    last = rows.filter("o_orderstatus NOT IN ('F', 'O')").drop("o_orderstatus")
    append(last.select(*(F.col(c).cast("string").alias(c) for c in ("level", "amount", "id", "date"))), lake)
    try:
        append(first.withColumn("level", F.lit("none")), lake)
    except ValueError:
        return read_table(spark, lake)
    raise AssertionError("a value that does not fit was appended")


# The latest day a lake lacks rows of, or else the latest day.
DAY_SQL = f"coalesce(max(CAST(o_orderdate AS DATE)) FILTER ({ORDERS_MISSING}), max(CAST(o_orderdate AS DATE)))"


def _day(spark, sf_dir):
    lost = (F.col("currency_code") == "P") & (F.col("type") == "1-URGENT")
    day = F.to_date("creation_date")
    return transactions(spark, sf_dir).agg(F.coalesce(F.max(F.when(lost, day)), F.max(day))).first()[0]


def _monthly(rows):
    return rows.withColumn("date", F.date_format("creation_date", "yyyyMM"))


@query(
    "recon_pruned_repaired",
    f"WITH day AS (SELECT {DAY_SQL} AS d FROM orders), s_rows AS (SELECT orders.* FROM orders, day WHERE CAST(o_orderdate AS DATE) = d), t_rows AS (SELECT * FROM s_rows)"
    + BY_AMOUNT_SQL[BY_AMOUNT_SQL.index("\n, s_ids") :]
    + """
SELECT s.d AS reconciliation_date, s.c AS currency_code, s.p AS type, s.n AS source_currency_type_transactions_total_for_date,
       t.n AS target_currency_type_transactions_total_for_date, s.amount AS source_sum_amount_for_currency_and_date,
       t.amount AS target_sum_amount_for_currency_and_date, t.total AS target_total_rowcount_for_date, 'match' AS outcome
FROM s JOIN t ON s.d = t.d AND s.c = t.c AND s.p = t.p
""",
)
def recon_pruned_repaired(spark, sf_dir):
    """A day's late rows are committed, then the day is compared: its own partition and the repair's are read."""
    lake, day, source = new_path(spark, "repaired"), _day(spark, sf_dir), transactions(spark, sf_dir)
    run_ts = datetime.combine(day + timedelta(days=1), datetime.min.time())
    ledger.create(spark, lake, Settings(day="creation_date", stream=AMOUNTS.stream))
    ledger.commit(_monthly(lake_transactions(spark, sf_dir)), lake)
    outcome, _, _ = reconcile_table(AMOUNTS, source, lake, run_ts, repair=True)
    recon = reconcile(AMOUNTS, source, ledger.rows_of_day(spark, lake, day), run_ts.date())
    wanted = ("currency_type_transactions_total_for_date", "sum_amount_for_currency_and_date")
    columns = [f"{side}_{c}" for c in wanted for side in ("source", "target")]
    return recon.select("reconciliation_date", "currency_code", "type", *columns, "target_total_rowcount_for_date", F.lit(outcome).alias("outcome"))


@query(
    "recon_parts_amounts",
    BY_AMOUNT_SQL
    + """
SELECT s.d AS reconciliation_date, s.c AS currency_code, s.p AS type, s.low AS source_min_id_for_date, s.high AS source_max_id_for_date,
       s.n AS source_currency_type_transactions_total_for_date, s.amount AS source_sum_amount_for_currency_and_date, s.total AS source_total_rowcount_for_date,
       t.low AS target_min_id_for_date, t.high AS target_max_id_for_date, t.n AS target_currency_type_transactions_total_for_date,
       t.amount AS target_sum_amount_for_currency_and_date, t.total AS target_total_rowcount_for_date
FROM s JOIN t ON s.d = t.d AND s.c = t.c AND s.p = t.p
""",
)
def recon_parts_amounts(spark, sf_dir):
    """All days, the lake's side from the figures that three commits have left."""
    lake, source, rows = new_path(spark, "parts"), transactions(spark, sf_dir), lake_transactions(spark, sf_dir)
    ledger.create(spark, lake, Settings(stream=AMOUNTS.stream))
    for part in ("type < '2'", "type >= '2' AND currency_code = 'F'", "type >= '2' AND currency_code <> 'F'"):
        ledger.commit(_monthly(rows.filter(part)), lake)
    return reconcile_parts(AMOUNTS, partial_figures(AMOUNTS, source, "source"), ledger.figures(spark, lake))


@query(
    "recon_parts_counts",
    f"""
WITH t AS (SELECT * FROM orders WHERE NOT ({ORDERS_MISSING}) UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F')
SELECT a.d AS reconciliation_date, a.n AS source_total_rowcount_for_date, a.k AS source_total_deposit_accounts_for_date,
       b.n AS target_total_rowcount_for_date, b.k AS target_total_deposit_accounts_for_date
FROM (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n, COUNT(DISTINCT o_orderkey) AS k FROM orders GROUP BY 1) a
JOIN (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n, COUNT(DISTINCT o_orderkey) AS k FROM t GROUP BY 1) b ON a.d = b.d
""",
)
def recon_parts_counts(spark, sf_dir):
    """Distinct keys of a day are told from two commits that share some of them."""
    lake, source, rows = new_path(spark, "counts"), transactions(spark, sf_dir), lake_transactions(spark, sf_dir)
    ledger.create(spark, lake, Settings(stream=ACCOUNTS.stream))
    ledger.commit(_monthly(rows), lake)
    ledger.commit(_monthly(rows.filter("currency_code = 'F'")), lake)
    return reconcile_parts(ACCOUNTS, partial_figures(ACCOUNTS, source, "source"), ledger.figures(spark, lake))


def _moved_events(spark, sf_dir):
    """The lake's events: some are lost, those of one type lie a day later, and some are of no source row."""
    rows = lake_events(spark, sf_dir).withColumn("ts", F.when(F.col("event_type") == "signup", F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts")))
    return rows.unionByName(rows.filter("event_type = 'view' AND value < 10").withColumn("event_id", -F.col("event_id") - 1))


@query(
    "digest_compare",
    f"""
SELECT event_id, CASE WHEN {EVENTS_MISSING} THEN 'left_only' ELSE 'both' END AS provenance FROM events
UNION ALL SELECT -event_id - 1, 'right_only' FROM events WHERE event_type = 'view' AND value < 10
""",
)
def digest_compare(spark, sf_dir):
    return compare_days(events(spark, sf_dir), _moved_events(spark, sf_dir), ["event_id"], "ts")


@query(
    "digest_differences",
    f"""
SELECT event_id, 'left_only' AS provenance FROM events WHERE {EVENTS_MISSING}
UNION ALL SELECT -event_id - 1, 'right_only' FROM events WHERE event_type = 'view' AND value < 10
""",
)
def digest_differences(spark, sf_dir):
    return differences(events(spark, sf_dir), _moved_events(spark, sf_dir), ["event_id"], "ts")


def _landed(spark, sf_dir, at):
    return events(spark, sf_dir).select(
        F.col("event_id").alias("encodedKey"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("creationDate"),
        F.col("value").cast("string").alias("amount"),
    )


ACCOUNT_TYPES = TableCatalog({"encoded_key": "bigint", "creation_date": "timestamp", "amount": "double", "booked_date": "timestamp"})
ACCOUNT_EVENT = {"table_name": "Accounts", "endpoint": "deposits:search", "request_type": "POST", "cdc_field": "creationDate"}


@query(
    "backfill_ingest_chunks",
    WEEK_PLAN
    + """
SELECT event_id AS encoded_key, strftime(h, '%Y%m%d') AS date, COUNT(*) AS times, 2 AS outcome
FROM plan JOIN (SELECT event_id, date_trunc('hour', ts) AS h FROM events) e ON h BETWEEN start_date AND end_date
WHERE chunk_num <> 2 GROUP BY 1, 2
""",
)
def backfill_ingest_chunks(spark, sf_dir):
    """Weekly chunks of hours, landed by chunk once; a date in the second one cannot be read, so it fails alone."""
    lake, (start, end) = new_path(spark, "backfilled"), _range(spark, sf_dir)
    hour = F.date_trunc("hour", "ts")
    first, last = (F.lit(str(start + timedelta(hours=n * WEEK))).cast("timestamp") for n in (1, 2))
    booked = F.when((hour > first) & (hour < last), "not yet").otherwise("2024-01-01")
    landed = _landed(spark, sf_dir, hour)
    dated = events(spark, sf_dir).select(F.col("event_id").alias("encodedKey"), booked.alias("bookedDate"))
    event = {**ACCOUNT_EVENT, "start_date": str(start), "end_date": str(end), "chunk_hours": WEEK}
    code, _ = backfill_ingest(spark, event, landed.join(dated, "encodedKey"), lake, RUN_TS, ACCOUNT_TYPES)
    return read_table(spark, lake).groupBy("encoded_key", "date").agg(F.count("*").alias("times")).withColumn("outcome", F.lit(code))


FROM, MIDDLE, TO = "2024-01-05 06:00:00", "2024-01-12 00:00:00", "2024-01-20 18:00:00"


@query(
    "ingest_committed_bookmark",
    f"""
WITH a AS (SELECT * FROM events WHERE ts BETWEEN TIMESTAMP '{FROM}' AND TIMESTAMP '{MIDDLE}'),
     b AS (SELECT * FROM events WHERE ts >= (SELECT MAX(ts) FROM a) AND ts <= TIMESTAMP '{TO}')
SELECT strftime(ts, '%Y%m%d') AS date, COUNT(*) AS n, COUNT(DISTINCT event_id) AS keys,
       (SELECT strftime(MAX(ts), '%Y-%m-%dT%H:%M:%S.%f+00:00') FROM b) AS bookmark
FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1
""",
)
def ingest_committed_bookmark(spark, sf_dir):
    """The second run starts where the first one's commit ends; both ends are included."""
    lake, landed = new_path(spark, "bookmarked"), _landed(spark, sf_dir, F.col("ts"))
    ingest_next(spark, {**ACCOUNT_EVENT, "start_date": FROM, "end_date": MIDDLE}, landed, lake, RUN_TS, ACCOUNT_TYPES)
    ingest_next(spark, {**ACCOUNT_EVENT, "end_date": TO}, landed, lake, RUN_TS, ACCOUNT_TYPES)
    days = read_table(spark, lake).groupBy("date").agg(F.count("*").alias("n"), F.countDistinct("encoded_key").alias("keys"))
    return days.withColumn("bookmark", F.lit(ledger.bookmark(spark, lake)))


@query(
    "refresh_installments_job",
    """
SELECT CAST(o_orderkey AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS encoded_key, CAST(o_orderkey AS VARCHAR) AS loan_account_id,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS principal_amount_due
FROM (SELECT *, UNNEST(generate_series(1, greatest(1, o_custkey % 4))) AS i FROM orders WHERE o_orderstatus <> 'P')
""",
)
def refresh_installments_job(spark, sf_dir):
    """Two runs, the second with other amounts for some loans: theirs are replaced, all other loans stay."""
    target, registry = new_path(spark, "installments"), new_path(spark, "leaves")
    orders = table(spark, sf_dir, "orders")
    accounts = orders.select(F.col("o_orderkey").cast("string").alias("id"))
    refresh_installments(_schedule_documents(spark, sf_dir), accounts, target, RUN_TS, registry=registry)
    changed = _schedule_documents(spark, sf_dir, orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1))
    refresh_installments(changed, accounts, target, RUN_TS + timedelta(hours=8), registry=registry)
    return read_table(spark, target).select("encoded_key", "loan_account_id", F.col("principal_amount_due").cast("double").alias("principal_amount_due"))


@query(
    "installments_known_paths",
    """
SELECT CAST(o_orderkey AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS encoded_key, CAST(o_orderkey AS VARCHAR) AS loan_account_id,
       CASE WHEN o_orderstatus = 'O' AND i = 3 THEN o_orderpriority END AS fee_details_1_id,
       CASE WHEN o_orderstatus = 'O' AND i = 3 THEN NULL ELSE '' END AS fee_details, NULL AS reason
FROM (SELECT *, UNNEST(generate_series(1, greatest(1, o_custkey % 4))) AS i FROM orders WHERE o_orderstatus <> 'P')
UNION ALL
SELECT NULL, CAST(o_orderkey AS VARCHAR), NULL, NULL, CASE WHEN o_orderpriority = '5-LOW' THEN 'INVALID_LOAN_ACCOUNT_ID' ELSE 'LOCKED' END
FROM orders WHERE o_orderstatus = 'P'
""",
)
def installments_known_paths(spark, sf_dir):
    """The paths are learnt from the schedules; then some third installments bring fees, whose paths are found in them alone."""
    registry, documents = new_path(spark, "leaves"), _schedule_documents(spark, sf_dir)
    accounts = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    installments_known(documents, accounts, registry)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("loan_account_id"), "o_orderstatus", "o_orderpriority")
    # The last installment of a schedule ends its text.
    fees = F.concat(F.lit('"feeDetails":[{"amount":0},{"id":"'), F.col("o_orderpriority"), F.lit('"}]}]}'))
    third = (F.col("o_orderstatus") == "O") & F.col("document").contains('"number":"3"')
    document = F.when(third, F.regexp_replace("document", F.lit(r'"feeDetails":\[\]\}\]\}$'), fees)).otherwise(F.col("document"))
    flat, rejects = installments_known(documents.join(orders, "loan_account_id").select("loan_account_id", document.alias("document")), accounts, registry)
    rows = installment_table(flat).select("encoded_key", "loan_account_id", "fee_details_1_id", "fee_details", F.lit(None).cast("string").alias("reason"))
    nothing = [F.lit(None).cast("string").alias(c) for c in ("fee_details_1_id", "fee_details")]
    return rows.unionByName(rejects.select(F.lit(None).cast("string").alias("encoded_key"), "loan_account_id", *nothing, "reason"))


@query(
    "page_slice_deep",
    """
SELECT event_id, event_type FROM (SELECT *, row_number() OVER (ORDER BY event_type, ts, event_id) AS n, COUNT(*) OVER () AS total FROM events)
WHERE n > total * 3 // 4 AND n <= total * 3 // 4 + 250
""",
)
def page_slice_deep(spark, sf_dir):
    """A slice behind three quarters of the table, whose first key has a handful of values."""
    rows = events(spark, sf_dir)
    return page_slice(rows, ["event_type", "ts", "event_id"], rows.count() * 3 // 4, 250, near=300).select("event_id", "event_type")


ODD = "a\"b'c"


@query("flatten_odd_keys", "SELECT p_partkey, p_name AS quoted, CAST(p_size AS VARCHAR) AS both_quotes, p_brand AS deep FROM part")
def flatten_odd_keys(spark, sf_dir):
    """Keys with one kind of quote, and with both, at the top and below."""
    key = json.dumps(ODD)
    text = F.concat(
        F.lit('{"it\'s":'), F.to_json(F.struct("p_name")), F.lit(f",{key}:"), F.col("p_size").cast("string"),
        F.lit(f',"in":{{{key}:[{{"x":"'), F.col("p_brand"), F.lit('"}]}}'),
    )
    flat = flatten(table(spark, sf_dir, "part").select("p_partkey", text.alias("d")), "d")
    names = {"p_partkey": "p_partkey", "it's_p_name": "quoted", ODD: "both_quotes", f"in_{ODD}_0_x": "deep"}
    return flat.select(*(F.col(f"`{name}`").alias(new) for name, new in names.items()))


@query("select_odd_keys", "SELECT p_partkey, p_name AS one, CAST(p_size AS VARCHAR) AS other FROM part")
def select_odd_keys(spark, sf_dir):
    text = F.concat(F.lit('{"it\'s":"'), F.col("p_name"), F.lit(f'",{json.dumps(ODD)}:'), F.col("p_size").cast("string"), F.lit("}"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.parse_json(text).alias("d"))
    return rows.select("p_partkey", select_objects(F.col("d"), ["it's"]).cast("string").alias("one"), select_objects(F.col("d"), [ODD]).cast("string").alias("other"))


@query(
    "clean_json_nested",
    r"""SELECT p_partkey, '{"a  b":"' || p_name || ' ' || p_brand || '","deep":{"k\tk":["' || p_brand || ' ' || p_type || '","c:\\new"]}}' AS d FROM part""",
)
def clean_json_nested(spark, sf_dir):
    """Strings are cleaned wherever they are; keys, also those with breaks in them, and escaped backslashes stay."""
    text = F.concat(
        F.lit('{"a  b":"'), F.col("p_name"), F.lit("  "), F.col("p_brand"), F.lit('","deep":{"k\\tk":["'),
        F.col("p_brand"), F.lit("\\n"), F.col("p_type"), F.lit('","c:\\\\new"]}}'),
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", text.alias("d"))
    return process_response(rows, "d", clean=True).withColumn("d", F.to_json("d"))


@query(
    "leftover_columns",
    """
SELECT o_orderkey AS id, '{"status":"' || o_orderstatus || '","customer":' || o_custkey || '}' AS holder, o_orderpriority AS note,
       '20240201' AS date, '2024-02-01 01:00:00.000000' AS timestamp_extracted FROM orders
""",
)
def leftover_columns(spark, sf_dir):
    """Columns no catalog lists: a struct becomes JSON text, text stays."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer")).alias("holder"), F.col("o_orderpriority").alias("note")
    )
    shaped, _ = process_records(rows, RUN_TS, catalog=TableCatalog({"id": "bigint"}))
    return shaped.withColumn("timestamp_extracted", stamp("timestamp_extracted"))


COMMENTS = {"c_custkey": "Number of the customer", "c_name": "Name of the customer", "c_acctbal": "Balance of the account"}


@query(
    "catalog_comments",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{text}' AS comment, COUNT({c}) AS filled FROM customer" for c, text in COMMENTS.items()),
)
def catalog_comments(spark, sf_dir):
    """A database is created and a table in it written twice, with comments; they are read back from the catalog."""
    database = f"tidemark_{uuid.uuid4().hex[:12]}"
    create_database(spark, database)
    create_database(spark, database)
    rows = table(spark, sf_dir, "customer").select(*COMMENTS, F.col("c_nationkey").cast("string").alias("date"))
    append(rows.filter("c_nationkey < 10"), f"{database}.customers", comments=COMMENTS)
    append(rows.filter("c_nationkey >= 10"), f"{database}.customers")
    stored = spark.table(f"{database}.customers")
    told = F.array(*(F.struct(F.lit(f.name).alias("column_name"), F.lit(f.metadata["comment"]).alias("comment"), F.col(f.name).isNotNull().alias("there")) for f in stored.schema if "comment" in f.metadata))
    return stored.select(F.inline(told)).groupBy("column_name", "comment").agg(F.count_if("there").alias("filled"))


@query(
    "reconcile_stream_job",
    f"""
WITH day AS (SELECT {DAY_SQL} AS d FROM orders), s AS (SELECT orders.*, d FROM orders, day WHERE CAST(o_orderdate AS DATE) = d)
SELECT 'deposit_accounts' AS stream, d AS reconciliation_date, 'total_deposit_accounts_for_date' AS figure, CAST(COUNT(*) AS DOUBLE) AS source,
       CAST(COUNT(*) FILTER (NOT ({ORDERS_MISSING})) AS DOUBLE) AS target, CASE WHEN COUNT(*) FILTER ({ORDERS_MISSING}) = 0 THEN 0 ELSE -1 END AS status
FROM s GROUP BY d HAVING COUNT(*) FILTER (NOT ({ORDERS_MISSING})) > 0
""",
)
def reconcile_stream_job(spark, sf_dir):
    """Yesterday's result rows are kept as CSV and checked."""
    lake, results, day = new_path(spark, "lake"), new_path(spark, "results"), _day(spark, sf_dir)
    append(_monthly(lake_transactions(spark, sf_dir)), lake)
    run_ts = datetime.combine(day + timedelta(days=1), datetime.min.time())
    _, checks = reconcile_stream(ACCOUNTS, transactions(spark, sf_dir), lambda: read_table(spark, lake), results, run_ts)
    return checks


def _cells(fields: str) -> str:
    return ", ".join(
        f"CASE WHEN i2 = '{f}' THEN COALESCE(v2, '0') WHEN i1 = '{f}' THEN COALESCE(v1, '0') WHEN i0 = '{f}' THEN COALESCE(v0, '0') ELSE 'None' END AS \"{f}\""
        for f in fields
    )


@query(
    "pivot_table_job",
    SLOTS + f"SELECT id, encoded_key, '2024-01-05' AS creation_date, {_cells('RF')}, '20240201' AS date FROM slots WHERE i0 IN ('R', 'F') OR i1 IN ('R', 'F') OR i2 IN ('R', 'F')",
)
def pivot_table_job(spark, sf_dir):
    """The pivoted table of two fields, written twice; the second run replaces it."""
    target, rows = new_path(spark, "pivoted"), _slots(spark, sf_dir).withColumn("creation_date", F.lit("2024-01-05 10:00:00"))
    for _ in range(2):
        pivot_table(rows, ["R", "F"], target, RUN_TS, slots=3)
    return read_table(spark, target).withColumn("creation_date", F.date_format("creation_date", "yyyy-MM-dd"))


@query(
    "refresh_products_job",
    "SELECT p_name AS product_name, CAST(p_size AS VARCHAR) AS limits_max, strftime(TIMESTAMP '2024-01-01', '%Y-%m-%d %H:%M:%S.%f') AS creation_date FROM part",
)
def refresh_products_job(spark, sf_dir):
    """The product table is replaced by each run."""
    target = new_path(spark, "products")
    for size in (F.lit(0), F.col("p_size")):
        product = F.struct(F.col("p_name").alias("productName"), F.struct(size.alias("max")).alias("limits"), F.lit("2024-01-01T00:00:00Z").alias("creationDate"))
        documents = table(spark, sf_dir, "part").select(F.to_json(F.struct(F.array(product).alias("loanProducts"))).alias("document"))
        refresh_products(documents, target, RUN_TS)
    return read_table(spark, target).select("product_name", "limits_max", stamp("creation_date").alias("creation_date"))


@query("channel_fields_job", CHANNEL_ROWS)
def channel_fields_job(spark, sf_dir):
    """Card and transfer fields, replacing the table by day."""
    target = new_path(spark, "channels")
    for _ in range(2):
        extract_channel_fields(_card_events(spark, sf_dir), target, names=("click",))
    return read_table(spark, target).select("id", F.col("custom_fields_0_id").alias("kind"), "date")
