"""Reconciliation queries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.operators.reconcile import (
    SPECS,
    ReconSpec,
    check_counts,
    distinct_count,
    extremes,
    keys_of_day,
    reconcile,
    rows_per_day,
)
from tidemark.queries.registry import (
    EVENTS_MISSING,
    ORDERS_MISSING,
    events,
    lake_events,
    lake_transactions,
    query,
    stamp,
    table,
    transactions,
)
from tidemark.sources.reads import run_sql

EVENT_SPEC = ReconSpec("events", "ts", "user_id", "users", check=("total_rowcount_for_date", "total_users_for_date"))
ACCOUNTS = SPECS["deposit_accounts"]
RUN_TS = datetime(2024, 1, 16, 3, 0)
RUN_DATE = RUN_TS.date()

DAILY_SQL = f"""
WITH s AS (
  SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n, COUNT(DISTINCT o_orderkey) AS k FROM orders GROUP BY 1
), t AS (
  SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n, COUNT(DISTINCT o_orderkey) AS k
  FROM orders WHERE NOT ({ORDERS_MISSING}) GROUP BY 1
)
"""


@query(
    "recon_daily_counts",
    DAILY_SQL
    + """
SELECT s.d AS reconciliation_date, s.n AS source_total_rowcount_for_date,
       s.k AS source_total_deposit_accounts_for_date, t.n AS target_total_rowcount_for_date,
       t.k AS target_total_deposit_accounts_for_date
FROM s JOIN t ON s.d = t.d
""",
)
def recon_daily_counts(spark, sf_dir):
    return reconcile(ACCOUNTS, transactions(spark, sf_dir), lake_transactions(spark, sf_dir))


@query(
    "recon_all_days",
    DAILY_SQL
    + """
SELECT s.d AS reconciliation_date, s.n AS source_total_rowcount_for_date, t.n AS target_total_rowcount_for_date
FROM s LEFT JOIN t ON s.d = t.d
""",
)
def recon_all_days(spark, sf_dir):
    recon = reconcile(ACCOUNTS, transactions(spark, sf_dir), lake_transactions(spark, sf_dir), how="left")
    return recon.select("reconciliation_date", "source_total_rowcount_for_date", "target_total_rowcount_for_date")


@query(
    "count_check_status",
    DAILY_SQL
    + """
SELECT 'deposit_accounts' AS stream, s.d AS reconciliation_date, 'total_deposit_accounts_for_date' AS figure,
       CAST(s.k AS DOUBLE) AS source, CAST(t.k AS DOUBLE) AS target, CASE WHEN s.k = t.k THEN 0 ELSE -1 END AS status
FROM s JOIN t ON s.d = t.d
""",
)
def count_check_status(spark, sf_dir):
    recon = reconcile(ACCOUNTS, transactions(spark, sf_dir), lake_transactions(spark, sf_dir))
    return check_counts(recon, ACCOUNTS)


AMOUNTS_SQL = """
, {side}_ids AS (
  SELECT CAST(o_orderdate AS DATE) AS d, MIN(o_orderkey) AS low, MAX(o_orderkey) AS high, COUNT(*) AS n
  FROM {side}_rows GROUP BY 1
), {side}_amounts AS (
  SELECT CAST(o_orderdate AS DATE) AS d, o_orderstatus AS c, o_orderpriority AS p, COUNT(*) AS n,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS DECIMAL(20,2)) AS amount
  FROM {side}_rows GROUP BY 1, 2, 3
), {side} AS (
  SELECT a.d, a.c, a.p, a.n, a.amount, i.low, i.high, i.n AS total FROM {side}_ids i JOIN {side}_amounts a ON i.d = a.d
)
"""
BY_AMOUNT_SQL = (
    f"WITH s_rows AS (SELECT * FROM orders), t_rows AS (SELECT * FROM orders WHERE NOT ({ORDERS_MISSING}))"
    + AMOUNTS_SQL.format(side="s")
    + AMOUNTS_SQL.format(side="t")
)


@query(
    "recon_daily_amounts",
    BY_AMOUNT_SQL
    + """
SELECT s.d AS reconciliation_date, s.c AS currency_code, s.p AS type,
       s.low AS source_min_id_for_date, s.high AS source_max_id_for_date,
       s.n AS source_currency_type_transactions_total_for_date,
       s.amount AS source_sum_amount_for_currency_and_date, s.total AS source_total_rowcount_for_date,
       t.low AS target_min_id_for_date, t.high AS target_max_id_for_date,
       t.n AS target_currency_type_transactions_total_for_date,
       t.amount AS target_sum_amount_for_currency_and_date, t.total AS target_total_rowcount_for_date
FROM s JOIN t ON s.d = t.d AND s.c = t.c AND s.p = t.p
""",
)
def recon_daily_amounts(spark, sf_dir):
    return reconcile(SPECS["deposit_transactions"], transactions(spark, sf_dir), lake_transactions(spark, sf_dir))


TARGET_TEXT = """
WITH ids AS (
  SELECT to_date(creation_date) AS date, MIN(CAST(id AS bigint)) AS min_id, MAX(CAST(id AS bigint)) AS max_id,
         COUNT(*) AS total
  FROM {transactions} GROUP BY to_date(creation_date)
), amounts AS (
  SELECT to_date(creation_date) AS date, currency_code, type,
         CAST(SUM(CAST(amount AS decimal(20,2))) AS decimal(20,2)) AS amount, COUNT(*) AS n
  FROM {transactions} GROUP BY to_date(creation_date), currency_code, type
)
SELECT ids.date, min_id, max_id, total, currency_code, type, amount, n
FROM ids JOIN amounts ON ids.date = amounts.date
WHERE ids.date >= :from_date
ORDER BY ids.date DESC, currency_code DESC
"""


@query(
    "recon_target_sql",
    "WITH t_rows AS (SELECT * FROM orders)"
    + AMOUNTS_SQL.format(side="t")
    + """
SELECT d AS date, low AS min_id, high AS max_id, total, c AS currency_code, p AS type, amount, n
FROM t WHERE d >= DATE '1997-01-01'
""",
)
def recon_target_sql(spark, sf_dir):
    transactions(spark, sf_dir).createOrReplaceTempView("tidemark_transactions")
    text = TARGET_TEXT.replace("{transactions}", "tidemark_transactions")
    return run_sql(spark, text, from_date=date(1997, 1, 1))


@query(
    "recon_events_daily",
    f"""
WITH s AS (SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n, COUNT(DISTINCT user_id) AS k FROM events GROUP BY 1),
     t AS (SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n, COUNT(DISTINCT user_id) AS k
           FROM events WHERE NOT ({EVENTS_MISSING}) GROUP BY 1)
SELECT s.d AS reconciliation_date, s.n AS source_total_rowcount_for_date, s.k AS source_total_users_for_date,
       t.n AS target_total_rowcount_for_date, t.k AS target_total_users_for_date
FROM s JOIN t ON s.d = t.d
""",
)
def recon_events_daily(spark, sf_dir):
    return reconcile(EVENT_SPEC, events(spark, sf_dir), lake_events(spark, sf_dir))


@query(
    "recon_run_day",
    f"""
SELECT s.d AS reconciliation_date, s.n AS source_total_rowcount_for_date, s.k AS source_total_users_for_date,
       t.n AS target_total_rowcount_for_date, t.k AS target_total_users_for_date,
       '2024-01-16 03:00:00.000000' AS extracted
FROM (SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n, COUNT(DISTINCT user_id) AS k FROM events GROUP BY 1) s
JOIN (SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n, COUNT(DISTINCT user_id) AS k
      FROM events WHERE NOT ({EVENTS_MISSING}) GROUP BY 1) t ON s.d = t.d
WHERE s.d = DATE '2024-01-15'
""",
)
def recon_run_day(spark, sf_dir):
    recon = reconcile(EVENT_SPEC, events(spark, sf_dir), lake_events(spark, sf_dir), RUN_DATE, RUN_TS)
    return recon.withColumn("extracted", stamp("timestamp_extracted")).drop("timestamp_extracted")


@query(
    "recon_snapshot",
    """
SELECT DATE '2024-01-15' AS reconciliation_date,
       (SELECT COUNT(*) FROM customer) AS source_total_rowcount_for_date,
       (SELECT COUNT(DISTINCT c_name) FROM customer) AS source_total_gl_accounts_for_date,
       COUNT(*) AS target_total_rowcount_for_date, COUNT(DISTINCT c_name) AS target_total_gl_accounts_for_date
FROM customer WHERE c_mktsegment <> 'MACHINERY'
""",
)
def recon_snapshot(spark, sf_dir):
    accounts = table(spark, sf_dir, "customer").withColumnRenamed("c_name", "gl_code")
    seen = accounts.withColumn("timestamp_extracted", F.lit("2024-01-15 01:00:00").cast("timestamp"))
    return reconcile(SPECS["gl_accounts"], accounts, seen.filter("c_mktsegment <> 'MACHINERY'"), RUN_DATE)


@query(
    "recon_key_ids",
    "SELECT DISTINCT CAST(ts AS DATE) AS ts, user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
)
def recon_key_ids(spark, sf_dir):
    return keys_of_day(events(spark, sf_dir), "ts", "user_id", date(2024, 1, 15))


@query(
    "modified_per_day",
    "SELECT CAST(o_orderdate AS DATE) AS o_orderdate, COUNT(*) AS total_count FROM orders GROUP BY 1",
)
def modified_per_day(spark, sf_dir):
    return rows_per_day(table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "timestamp_extremes",
    """
SELECT strftime(MIN(ts), '%Y-%m-%d %H:%M:%S.%f') AS min_ts, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S.%f') AS max_ts
FROM events
""",
)
def timestamp_extremes(spark, sf_dir):
    return extremes(events(spark, sf_dir), "ts").select(
        stamp("min_ts").alias("min_ts"), stamp("max_ts").alias("max_ts")
    )


@query("distinct_count", "SELECT COUNT(DISTINCT user_id) AS distinct_keys, COUNT(*) AS total_rows FROM events")
def global_distinct_count(spark, sf_dir):
    return distinct_count(events(spark, sf_dir), "user_id")
