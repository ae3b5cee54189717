"""Key comparison and repair queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.coerce import key_number, key_text
from tidemark.functions.text import fill_missing
from tidemark.operators.diff import compare_keys, missing_rows, missing_versions, provenance_counts
from tidemark.operators.reconcile import ReconSpec
from tidemark.operators.repair import late_rows, repair_and_reconcile
from tidemark.plans.ingest import three_way_backfill
from tidemark.plans.staging import new_path, restrict_to_keys
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
from tidemark.sinks import tables
from tidemark.sources.reads import distinct_keys

RUN_TS = datetime(2024, 1, 16, 3, 0)


def _lake_customers(spark, sf_dir):
    """Customers as the lake has them: one segment is lost, suppliers' keys were added."""
    kept = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'MACHINERY'").select("c_custkey")
    count = table(spark, sf_dir, "customer").agg(F.max("c_custkey") + 1).scalar()
    return kept.unionByName(table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + count).alias("c_custkey")))


LAKE_KEYS = """
SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY'
UNION ALL SELECT s_suppkey + (SELECT MAX(c_custkey) + 1 FROM customer) FROM supplier
"""
COMPARED = f"""
SELECT COALESCE(s.k, t.k) AS c_custkey,
       CASE WHEN t.k IS NULL THEN 'left_only' WHEN s.k IS NULL THEN 'right_only' ELSE 'both' END AS provenance
FROM (SELECT DISTINCT c_custkey AS k FROM customer) s
FULL OUTER JOIN (SELECT DISTINCT c_custkey AS k FROM ({LAKE_KEYS})) t ON s.k = t.k
"""


@query("three_way_diff", COMPARED)
def three_way_diff(spark, sf_dir):
    return compare_keys(table(spark, sf_dir, "customer"), _lake_customers(spark, sf_dir), ["c_custkey"])


@query("three_way_counts", f"SELECT provenance, COUNT(*) AS keys FROM ({COMPARED}) GROUP BY provenance")
def three_way_counts(spark, sf_dir):
    return provenance_counts(
        compare_keys(table(spark, sf_dir, "customer"), _lake_customers(spark, sf_dir), ["c_custkey"])
    )


@query(
    "diff_repeated_keys",
    """
SELECT COALESCE(s.k, t.k) AS user_id, COALESCE(s.e, t.e) AS event_type,
       CASE WHEN t.k IS NULL THEN 'left_only' WHEN s.k IS NULL THEN 'right_only' ELSE 'both' END AS provenance
FROM (SELECT DISTINCT user_id AS k, event_type AS e FROM events WHERE value >= 10) s
FULL OUTER JOIN (SELECT DISTINCT user_id AS k, event_type AS e FROM events WHERE value < 10) t ON s.k = t.k AND s.e = t.e
""",
)
def diff_repeated_keys(spark, sf_dir):
    rows = events(spark, sf_dir)
    return compare_keys(rows.filter("value >= 10"), rows.filter("value < 10"), ["user_id", "event_type"])


@query(
    "missing_rows",
    f"""
SELECT o_orderkey AS id, o_custkey AS account_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS creation_date,
       o_totalprice AS amount, o_orderstatus AS currency_code, o_orderpriority AS type
FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE NOT ({ORDERS_MISSING}))
""",
)
def missing_rows_query(spark, sf_dir):
    missing = missing_rows(transactions(spark, sf_dir), lake_transactions(spark, sf_dir), ["id"])
    return missing.withColumn("creation_date", stamp("creation_date"))


@query(
    "rows_of_missing_keys",
    """
SELECT event_id, user_id, event_type, value FROM events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE value > 200)
""",
)
def rows_of_missing_keys(spark, sf_dir):
    rows = events(spark, sf_dir)
    return missing_rows(rows, rows.filter("value > 200"), ["user_id"]).select(
        "event_id", "user_id", "event_type", "value"
    )


@query(
    "multi_key_anti",
    """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer s
WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT c_custkey, c_name, c_nationkey,
                        CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer) t
  WHERE t.c_custkey = s.c_custkey AND t.c_name = s.c_name AND t.c_nationkey = s.c_nationkey
    AND t.c_mktsegment IS NOT DISTINCT FROM s.c_mktsegment)
""",
)
def multi_key_anti(spark, sf_dir):
    source = table(spark, sf_dir, "customer")
    # The lake holds another version of the customers in debt.
    lake = source.withColumn("c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))
    return missing_versions(source, lake, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


LATE_SQL = f"""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts, value, '20240116' AS date
FROM events WHERE event_id IN (
  SELECT event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'
  EXCEPT
  SELECT event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' AND NOT ({EVENTS_MISSING}))
"""


@query("late_row_repair", LATE_SQL)
def late_row_repair(spark, sf_dir):
    late = late_rows(
        events(spark, sf_dir), lake_events(spark, sf_dir), RUN_TS, key="event_id", day_column="ts"
    )
    return late.select("event_id", "ts", "value", "date")


@query(
    "late_row_repair_rerun",
    """
SELECT DATE '2024-01-15' AS reconciliation_date, COUNT(*) AS source_total_rowcount_for_date,
       COUNT(DISTINCT event_id) AS source_total_events_for_date, COUNT(*) AS target_total_rowcount_for_date,
       COUNT(DISTINCT event_id) AS target_total_events_for_date
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'
""",
)
def late_row_repair_rerun(spark, sf_dir):
    spec = ReconSpec("events", "ts", "event_id", "events", check=("total_rowcount_for_date",))
    lake = new_path(spark, "late")

    def append(rows):
        tables.append(rows.withColumn("ts", F.to_timestamp("ts")), lake)

    tables.append(lake_events(spark, sf_dir).withColumn("date", F.date_format("ts", "yyyyMMdd")), lake)
    final, _ = repair_and_reconcile(
        spec,
        events(spark, sf_dir),
        lambda: spark.read.option("mergeSchema", "true").parquet(lake),
        RUN_TS,
        append,
    )
    return final.drop("timestamp_extracted")


@query(
    "backfill_apply",
    """
SELECT 'both' AS provenance, COUNT(*) AS keys FROM customer
UNION ALL SELECT 'right_only', COUNT(*) FROM supplier
""",
)
def backfill_apply(spark, sf_dir):
    """After an applied backfill nothing of the source is missing."""
    source, lake = table(spark, sf_dir, "customer"), new_path(spark, "backfill")
    tables.append(_lake_customers(spark, sf_dir).withColumn("date", F.lit("20240101")).withColumn("c_custkey", F.col("c_custkey").cast("string")), lake)
    three_way_backfill(source, lake, "c_custkey", RUN_TS, apply=True)
    after = three_way_backfill(source, lake, "c_custkey", RUN_TS)
    found = {"left_only": after.not_in_lake, "right_only": after.not_in_source, "both": after.in_both}
    parts = [rows.select(F.lit(name).alias("provenance")) for name, rows in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("provenance").agg(F.count("*").alias("keys"))


@query("distinct_keys", "SELECT DISTINCT user_id FROM events")
def distinct_keys_query(spark, sf_dir):
    return distinct_keys(events(spark, sf_dir), "user_id")


@query(
    "key_membership",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')",
)
def key_membership(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return restrict_to_keys(table(spark, sf_dir, "lineitem"), wanted, ["l_orderkey"]).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query(
    "key_normalisation",
    """
SELECT CAST(c_custkey AS VARCHAR) AS key_text, CAST(CAST(c_custkey AS VARCHAR) AS BIGINT) AS key_number,
       CASE WHEN c_acctbal < 0 THEN '0' ELSE c_mktsegment END AS segment
FROM customer
""",
)
def key_normalisation(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        key_text(F.col("c_custkey")).alias("key_text"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"),
    )
    return fill_missing(rows).withColumn("key_number", key_number(F.col("key_text")))
