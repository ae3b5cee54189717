"""Reads, paging, chunks, bookmarks and incremental ingest."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.operators.bookmarks import (
    advance_bookmarks,
    archive_state,
    high_water_mark,
    initial_state,
    latest_state,
    load_state,
)
from tidemark.operators.chunks import chunk_counts, plan_chunks, run_chunks, summarise_chunks
from tidemark.plans.catalog import TableCatalog
from tidemark.plans.ingest import ingest, parse_event
from tidemark.plans.staging import new_path
from tidemark.queries.registry import events, query, stamp, table
from tidemark.sources.landed import explode_records, read_json_lines
from tidemark.sources.pages import complete_pages, last_page, number_rows, page_slice
from tidemark.sources.reads import cdc_range, ledger_accounts, loan_installments, read_stream, read_table, union_all
from tidemark.streaming.incremental import append_available, landed_stream, with_day

RUN_TS = datetime(2024, 2, 1, 1, 0)
FROM, TO = "2024-01-05 06:00:00", "2024-01-20 18:00:00"


@query(
    "category_union",
    """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ASSET' WHEN 'O' THEN 'INCOME' ELSE 'OTHER' END AS type,
       DATE '2024-01-31' AS balance_to_date
FROM orders WHERE o_orderstatus IN ('F', 'O')
""",
)
def category_union(spark, sf_dir):
    kind = F.when(F.col("o_orderstatus") == "F", "ASSET").when(F.col("o_orderstatus") == "O", "INCOME").otherwise("OTHER")
    accounts = table(spark, sf_dir, "orders").select("o_orderkey", kind.alias("type"))
    return ledger_accounts(accounts, date(2024, 2, 1))


@query(
    "differing_union",
    """
SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier
UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer
UNION ALL SELECT n_nationkey, NULL, NULL, NULL FROM nation
""",
)
def differing_union(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS key", "s_name AS name", "s_acctbal AS balance")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_mktsegment AS segment")
    nations = table(spark, sf_dir, "nation").selectExpr("CAST(n_nationkey AS bigint) AS key")
    return union_all([suppliers, customers, nations])


@query(
    "installment_states",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linestatus = 'F' THEN 'CLOSED' ELSE 'ACTIVE' END AS account_state
FROM lineitem WHERE l_returnflag <> 'N' AND l_shipdate + INTERVAL 24 YEAR BETWEEN TIMESTAMP '2022-01-01' AND TIMESTAMP '2122-01-01'
""",
)
def installment_states(spark, sf_dir):
    state = F.when(F.col("l_returnflag") == "N", "WITHDRAWN").when(F.col("l_linestatus") == "F", "CLOSED").otherwise("ACTIVE")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        state.alias("account_state"),
        F.add_months("l_shipdate", 288).alias("due_date"),
    )
    return loan_installments(rows).drop("due_date")


@query(
    "cdc_range",
    f"SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events WHERE ts BETWEEN TIMESTAMP '{FROM}' AND TIMESTAMP '{TO}'",
)
def cdc_range_query(spark, sf_dir):
    return cdc_range(table(spark, sf_dir, "events"), "ts", FROM, TO).select("event_id", stamp("ts").alias("ts"))


@query("cdc_range_text", f"SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '{FROM}' AND TIMESTAMP '{TO}'")
def cdc_range_text_query(spark, sf_dir):
    # The same instants as ISO text, in UTC for every second event and six hours ahead for the others.
    utc = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    ahead = F.date_format(F.col("ts") + F.expr("INTERVAL 6 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+06:00'")
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, utc).otherwise(ahead).alias("ts"))
    return cdc_range(rows, "ts", FROM, TO, iso_text=True).select("event_id")


@query(
    "read_dispatch",
    f"""
SELECT 'changes' AS read, COUNT(*) AS n FROM events WHERE ts BETWEEN TIMESTAMP '{FROM}' AND TIMESTAMP '{TO}'
UNION ALL SELECT 'full', COUNT(*) FROM customer
""",
)
def read_dispatch(spark, sf_dir):
    full = read_stream(table(spark, sf_dir, "customer"), "users", "get")
    changes = read_stream(table(spark, sf_dir, "events"), "clients:search", "post", cdc="ts", start=FROM, end=TO)
    parts = [full.select(F.lit("full").alias("read")), changes.select(F.lit("changes").alias("read"))]
    return union_all(parts).groupBy("read").agg(F.count("*").alias("n"))


@query("high_water_mark", "SELECT strftime(MAX(ts), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS bookmark FROM events")
def high_water_mark_query(spark, sf_dir):
    return high_water_mark(events(spark, sf_dir), "ts")


@query("whole_table", "SELECT * FROM customer")
def whole_table(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/customer.parquet")


def _pages(spark, sf_dir):
    """Orders in pages of 1000, one page short by one order."""
    rows = table(spark, sf_dir, "orders")
    hole = rows.agg(F.floor(F.max("o_orderkey") * 3 / 4)).scalar()
    return rows.filter(F.col("o_orderkey") != hole).withColumn("page", F.expr("o_orderkey div 1000"))


PAGES = """
WITH pages AS (
  SELECT o_orderkey, o_orderkey // 1000 AS page FROM orders
  WHERE o_orderkey <> (SELECT CAST(floor(MAX(o_orderkey) * 3 / 4) AS BIGINT) FROM orders)),
sizes AS (SELECT page, COUNT(*) AS n FROM pages GROUP BY page)
"""


@query("page_set", PAGES + "SELECT o_orderkey, page FROM pages WHERE page <= (SELECT MIN(page) FROM sizes WHERE n < 1000)")
def page_set(spark, sf_dir):
    return complete_pages(_pages(spark, sf_dir)).select("o_orderkey", "page")


@query("last_page", PAGES + "SELECT MIN(page) AS last_page FROM sizes WHERE n < 1000")
def last_page_query(spark, sf_dir):
    return last_page(_pages(spark, sf_dir))


@query("page_slice", "SELECT event_id, user_id FROM events ORDER BY ts, event_id LIMIT 250 OFFSET 500")
def page_slice_query(spark, sf_dir):
    """The third page of the ordered set: paging is the feature."""
    return page_slice(events(spark, sf_dir), ["ts", "event_id"], 500, 250).select("event_id", "user_id")


@query("row_pages", "SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 AS page FROM events")
def row_pages(spark, sf_dir):
    rows = number_rows(events(spark, sf_dir).select("event_id", "ts"), "ts", "event_id")
    return rows.select("event_id", F.expr("row_number div 1000").alias("page"))


@query("landed_json_lines", "SELECT event_id, event_type, value FROM events")
def landed_json_lines(spark, sf_dir):
    folder = new_path(spark, "landed")
    rows = events(spark, sf_dir).select("event_id", "event_type", "value")
    # The text writer names its files itself; the folder carries the stream's name.
    rows.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{folder}/events-1.jsonl")
    lines = read_json_lines(spark, folder, "events")
    parsed = F.from_json("record", "event_id bigint, event_type string, value double")
    return lines.select(parsed.alias("r")).select("r.*")


@query("exploded_documents", "SELECT event_id, CAST(UNNEST([user_id, user_id + 1]) AS VARCHAR) AS item FROM events")
def exploded_documents(spark, sf_dir):
    document = F.to_json(F.struct(F.array(F.col("user_id"), F.col("user_id") + 1).alias("items")))
    rows = events(spark, sf_dir).select("event_id", F.parse_json(document).alias("document"))
    return explode_records(rows, "document", ["items"], "item").withColumn("item", F.col("item").cast("string"))


CHUNK_HOURS = 20
BOUNDS = "SELECT date_trunc('hour', MIN(ts)) AS a, date_trunc('hour', MAX(ts)) + INTERVAL 1 HOUR AS z FROM events"
PLAN = f"""
WITH b AS ({BOUNDS}), plan AS (
  SELECT CAST(i + 1 AS INTEGER) AS chunk_num, a + i * INTERVAL {CHUNK_HOURS} HOUR AS start_date,
         least(a + (i + 1) * INTERVAL {CHUNK_HOURS} HOUR, z) AS end_date
  FROM b, UNNEST(generate_series(0, CAST(ceil(epoch(z - a) / ({CHUNK_HOURS} * 3600.0)) AS BIGINT) - 1)) AS t(i))
"""


def _range(spark, sf_dir) -> tuple[datetime, datetime]:
    """The hours the events span."""
    row = events(spark, sf_dir).agg(
        F.date_trunc("hour", F.min("ts")).alias("a"),
        (F.date_trunc("hour", F.max("ts")) + F.expr("INTERVAL 1 HOUR")).alias("z"),
    ).first()
    return row.a, row.z


@query(
    "chunk_plan",
    PLAN
    + """
SELECT chunk_num, strftime(start_date, '%Y-%m-%d %H:%M:%S.%f') AS start_date,
       strftime(end_date, '%Y-%m-%d %H:%M:%S.%f') AS end_date FROM plan
""",
)
def chunk_plan(spark, sf_dir):
    plan = plan_chunks(spark, *_range(spark, sf_dir), CHUNK_HOURS)
    return plan.withColumns({c: stamp(c) for c in ("start_date", "end_date")})


@query(
    "chunk_counts",
    PLAN + "SELECT chunk_num, COUNT(*) AS records_count FROM plan JOIN (SELECT date_trunc('hour', ts) AS h FROM events) e "
    "ON e.h BETWEEN plan.start_date AND plan.end_date GROUP BY chunk_num",
)
def chunk_counts_query(spark, sf_dir):
    """Event hours per chunk; hours on a boundary count for both chunks."""
    start, end = (F.lit(str(t)).cast("timestamp") for t in _range(spark, sf_dir))
    hours = events(spark, sf_dir).select(F.date_trunc("hour", "ts").alias("h"))
    return chunk_counts(hours, "h", start, end, CHUNK_HOURS)


@query(
    "chunk_counts_half_open",
    PLAN + "SELECT chunk_num, COUNT(*) AS records_count FROM plan JOIN (SELECT date_trunc('hour', ts) AS h FROM events) e "
    "ON e.h >= plan.start_date AND e.h < plan.end_date GROUP BY chunk_num",
)
def chunk_counts_half_open(spark, sf_dir):
    start, end = (F.lit(str(t)).cast("timestamp") for t in _range(spark, sf_dir))
    hours = events(spark, sf_dir).select(F.date_trunc("hour", "ts").alias("h"))
    return chunk_counts(hours, "h", start, end, CHUNK_HOURS, half_open=True)


WEEK = 168
WEEK_PLAN = PLAN.replace(f"INTERVAL {CHUNK_HOURS} HOUR", f"INTERVAL {WEEK} HOUR").replace(f"({CHUNK_HOURS} *", f"({WEEK} *")


@query(
    "chunk_summary",
    WEEK_PLAN
    + """
SELECT COUNT(*) AS chunks, COUNT(*) - 1 AS succeeded, 1 AS failed, CAST(SUM(n) AS BIGINT) AS records, 2 AS outcome
FROM (SELECT chunk_num, (SELECT COUNT(*) FROM events WHERE ts BETWEEN start_date AND end_date) * (chunk_num <> 2)::INT AS n FROM plan)
""",
)
def chunk_summary(spark, sf_dir):
    """Weekly chunks read one after another, the second of which fails."""
    rows, (start, end) = table(spark, sf_dir, "events"), _range(spark, sf_dir)
    seen = []

    def job(a, b):
        seen.append(a)
        if len(seen) == 2:
            raise RuntimeError("source not reachable")
        return cdc_range(rows, "ts", a, b, ordered=False).count()

    return summarise_chunks(run_chunks(plan_chunks(spark, start, end, WEEK), job))


def _state(spark, sf_dir):
    """A bookmark per event type, and sub-streams by order status."""
    newest = F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    streams = events(spark, sf_dir).groupBy(F.col("event_type").alias("stream")).agg(newest.alias("bookmark"))
    sub = F.when(F.col("o_orderstatus") == "F", "EQUITY").otherwise(F.col("o_orderstatus"))
    subs = table(spark, sf_dir, "orders").select(F.lit("gl_accounts").alias("stream"), sub.alias("substream")).distinct()
    return streams.withColumn("substream", F.lit(None).cast("string")).unionByName(initial_state(subs))


ADVANCED = """
SELECT event_type AS stream, NULL AS substream,
       CASE WHEN SUM(value) > 0 AND event_type <> 'error'
            THEN strftime(MAX(ts) + INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%S.%fZ')
            ELSE strftime(MAX(ts), '%Y-%m-%dT%H:%M:%S.%fZ') END AS bookmark
FROM events GROUP BY event_type
UNION ALL
SELECT DISTINCT 'gl_accounts', CASE o_orderstatus WHEN 'F' THEN 'EQUITY' ELSE o_orderstatus END,
       CASE o_orderstatus WHEN 'F' THEN '2020-01-01T00:00:01Z' ELSE '2020-01-01T00:00:01.000000Z' END
FROM orders
"""


def _status(spark, sf_dir):
    got = events(spark, sf_dir).groupBy(F.col("event_type").alias("stream")).agg((F.sum("value") > 0).alias("got"))
    mine = got.select("stream", (F.col("got") & (F.col("stream") != "error")).alias("updated"))
    ledger = table(spark, sf_dir, "orders").select(F.lit("gl_accounts").alias("stream"), F.lit(True).alias("updated")).distinct()
    return mine.unionByName(ledger)


@query("bookmark_advance", ADVANCED)
def bookmark_advance(spark, sf_dir):
    return advance_bookmarks(_state(spark, sf_dir), _status(spark, sf_dir))


@query("bookmark_history", ADVANCED)
def bookmark_history(spark, sf_dir):
    """The state archived before and after a run; the latest is what the next run reads."""
    path, state = new_path(spark, "bookmarks"), _state(spark, sf_dir)
    archive_state(state, path, RUN_TS)
    current = load_state(spark.read.parquet(path), initial_state(state))
    archive_state(advance_bookmarks(current, _status(spark, sf_dir)), path, RUN_TS.replace(hour=2))
    return latest_state(spark.read.parquet(path))


@query(
    "ingest_event",
    f"""
SELECT 'accounts' AS table_name, 'deposits:search' AS endpoint, 'creationDate' AS cdc_field,
       '2024-01-05T06:00:00+00:00' AS start_date, '2024-01-20T18:00:00+00:00' AS end_date, COUNT(*) AS records_count,
       COUNT(*) AS rows_in_lake, COUNT(DISTINCT CAST(ts AS DATE)) AS partitions
FROM events WHERE ts BETWEEN TIMESTAMP '{FROM}' AND TIMESTAMP '{TO}'
""",
)
def ingest_event(spark, sf_dir):
    landed = events(spark, sf_dir).select(
        F.col("event_id").alias("encodedKey"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("creationDate"),
        F.col("event_type").alias("eventType"),
        F.col("value").cast("string").alias("amount"),
    )
    event = parse_event(
        {
            "table_name": "Accounts",
            "endpoint": "deposits:search",
            "request_type": "POST",
            "cdc_field": "creationDate",
            "start_date": FROM,
            "end_date": TO,
        },
        RUN_TS,
    )
    catalog = TableCatalog({"encoded_key": "string", "creation_date": "timestamp", "amount": "double"})
    lake = new_path(spark, "accounts")
    summary = ingest(spark, event, landed, lake, RUN_TS, catalog)
    stored = spark.read.parquet(lake).agg(
        F.count("*").alias("rows_in_lake"), F.countDistinct("date").alias("partitions")
    )
    return summary.withColumns(
        {c: stored.select(c).scalar() for c in ("rows_in_lake", "partitions")}
    )


@query(
    "incremental_available_now",
    """
SELECT strftime(ts, '%Y%m%d') AS date, COUNT(*) AS n, COUNT(DISTINCT event_id) AS keys,
       CAST(SUM(CAST(value AS DECIMAL(20,2))) AS DECIMAL(20,2)) AS total FROM events GROUP BY 1
""",
)
def incremental_available_now(spark, sf_dir):
    """Two drops of files and three runs: the third run finds nothing new and adds nothing."""
    rows = events(spark, sf_dir)
    root = new_path(spark, "incremental")
    drop, lake, checkpoint = f"{root}/landed", f"{root}/lake", f"{root}/checkpoint"
    schema = "event_id bigint, ts timestamp, value double"

    def run():
        stream = landed_stream(spark, drop, schema)
        append_available(stream, lake, checkpoint, lambda df: with_day(df, "ts"))

    for part in (F.col("event_type") == "view", F.col("event_type") != "view"):
        rows.filter(part).select("event_id", "ts", "value").write.mode("append").json(drop)
        run()
    run()
    return spark.read.parquet(lake).groupBy("date").agg(
        F.count("*").alias("n"),
        F.countDistinct("event_id").alias("keys"),
        F.sum(F.col("value").cast("decimal(20,2)")).cast("decimal(20,2)").alias("total"),
    )
