"""Sink round trips: what a table holds after it was written."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators.reconcile import SPECS, reconcile, result_catalog
from tidemark.plans.staging import new_path
from tidemark.queries.registry import lake_transactions, query, stamp, table, transactions
from tidemark.sinks.tables import (
    append,
    append_csv,
    overwrite_partitions,
    overwrite_table,
    read_csv,
    write_debug_snapshot,
    write_report,
    write_streams,
)
from tidemark.sources.reads import read_table

RUN_TS = datetime(2024, 2, 1, 1, 0)


def _monthly(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyyMM").alias("date")
    )


@query(
    "append_evolve_roundtrip",
    """
SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y%m') AS date, NULL AS o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y%m'), o_orderpriority FROM orders WHERE o_orderstatus = 'P'
""",
)
def append_evolve_roundtrip(spark, sf_dir):
    """A second append brings a column the first lacks."""
    lake = new_path(spark, "evolve")
    append(_monthly(spark, sf_dir), lake)
    wider = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.date_format("o_orderdate", "yyyyMM").alias("date")
    )
    append(wider, lake)
    return read_table(spark, lake)


@query(
    "partition_overwrite_roundtrip",
    """
WITH monthly AS (SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y%m') AS date FROM orders),
     later AS (SELECT * FROM monthly WHERE date >= '199801' AND o_orderstatus = 'F')
SELECT * FROM monthly WHERE date NOT IN (SELECT date FROM later)
UNION ALL SELECT o_orderkey, 'new', date FROM later
""",
)
def partition_overwrite_roundtrip(spark, sf_dir):
    """Only the months the second batch has rows for are replaced."""
    lake = new_path(spark, "partitions")
    append(_monthly(spark, sf_dir), lake)
    later = _monthly(spark, sf_dir).filter("date >= '199801' AND o_orderstatus = 'F'")
    overwrite_partitions(later.withColumn("o_orderstatus", F.lit("new")), lake)
    return read_table(spark, lake)


@query(
    "key_partition_overwrite",
    """
SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS loan_account_id FROM customer WHERE c_nationkey >= 5
UNION ALL SELECT c_custkey, 'again', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey < 5
""",
)
def key_partition_overwrite(spark, sf_dir):
    """One directory per key; keys in the second batch are replaced."""
    lake = new_path(spark, "keyed")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_nationkey").cast("string").alias("loan_account_id")
    )
    append(rows, lake, ("loan_account_id",))
    again = rows.filter(F.col("loan_account_id").cast("int") < 5).withColumn("c_name", F.lit("again"))
    overwrite_partitions(again, lake, ("loan_account_id",))
    return read_table(spark, lake)


@query("table_overwrite_roundtrip", "SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y%m') AS date FROM orders WHERE o_orderstatus = 'F'")
def table_overwrite_roundtrip(spark, sf_dir):
    """The whole partitioned table is replaced."""
    lake = new_path(spark, "whole")
    append(_monthly(spark, sf_dir), lake)
    overwrite_table(_monthly(spark, sf_dir).filter("o_orderstatus = 'F'"), lake, ("date",))
    return read_table(spark, lake)


@query("unpartitioned_overwrite", "SELECT p_partkey, p_name FROM part WHERE p_size > 25")
def unpartitioned_overwrite(spark, sf_dir):
    lake, rows = new_path(spark, "config"), table(spark, sf_dir, "part")
    overwrite_table(rows.select("p_partkey", "p_name"), lake)
    overwrite_table(rows.filter("p_size > 25").select("p_partkey", "p_name"), lake)
    return read_table(spark, lake)


@query(
    "recon_csv_roundtrip",
    """
SELECT s.d AS reconciliation_date, CAST(s.n AS INTEGER) AS source_total_rowcount_for_date,
       CAST(s.n AS INTEGER) AS source_total_deposit_accounts_for_date, CAST(t.n AS INTEGER) AS target_total_rowcount_for_date,
       CAST(t.n AS INTEGER) AS target_total_deposit_accounts_for_date, '2024-02-01 01:00:00.000000' AS timestamp_extracted
FROM (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1) s
JOIN (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders
      WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') GROUP BY 1) t ON s.d = t.d
""",
)
def recon_csv_roundtrip(spark, sf_dir):
    spec, path = SPECS["deposit_accounts"], new_path(spark, "recon")
    recon = reconcile(spec, transactions(spark, sf_dir), lake_transactions(spark, sf_dir), run_ts=RUN_TS)
    append_csv(recon, path, result_catalog(spec))
    stored = read_csv(spark, path, result_catalog(spec))
    return stored.withColumn("timestamp_extracted", stamp("timestamp_extracted"))


@query("report_roundtrip", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'")
def report_roundtrip(spark, sf_dir):
    path = new_path(spark, "report")
    write_report(table(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY'").select("c_custkey", "c_name"), path)
    return spark.read.option("header", "true").csv(path)


@query("debug_snapshot", "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS type FROM orders")
def debug_snapshot(spark, sf_dir):
    rows = transactions(spark, sf_dir).select("id", "type")
    path = write_debug_snapshot(rows, new_path(spark, "debug"), "deposit_transactions", "recon", RUN_TS)
    return spark.read.option("header", "true").csv(path)


@query(
    "write_status",
    """
SELECT 'orders' AS stream, COUNT(*) > 0 AS updated, FALSE AS failed FROM orders
UNION ALL SELECT 'empty', COUNT(*) > 0, FALSE FROM orders WHERE o_totalprice < 0
UNION ALL SELECT 'broken', FALSE, COUNT(*) > 0 FROM orders
""",
)
def write_status(spark, sf_dir):
    root, rows = new_path(spark, "streams"), table(spark, sf_dir, "orders")

    def write(name, batch):
        if batch.isEmpty():
            return False
        overwrite_table(batch, f"{root}/{name}")
        return True

    # Text that is no number makes the last write fail.
    broken = rows.withColumn("o_orderpriority", F.col("o_orderpriority").cast("int"))
    jobs = {"orders": rows, "empty": rows.filter("o_totalprice < 0"), "broken": broken}
    status = write_streams(spark, [(name, lambda n=name, b=batch: write(n, b)) for name, batch in jobs.items()])
    return status.select("stream", "updated", F.col("error").isNotNull().alias("failed"))
