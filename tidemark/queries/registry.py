"""The registry and the input tables as the operators expect them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows where there is one."""

    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(column: Column | str) -> Column:
    """A timestamp as text, so that it compares equal across engines."""
    return F.date_format(column, STAMP)


# What a lake copy lacks, said by the rows' own values.
ORDERS_MISSING = "o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"
EVENTS_MISSING = "event_type = 'error' AND value < 5"


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions: status is the currency, priority the type."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderdate").alias("creation_date"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("currency_code"),
        F.col("o_orderpriority").alias("type"),
    )


def lake_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake's copy of the transactions, with losses."""
    kept = ~((F.col("currency_code") == "P") & (F.col("type") == "1-URGENT"))
    return transactions(spark, sf_dir).filter(kept)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def lake_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter(f"NOT ({EVENTS_MISSING})")
