"""Custom-field queries: line items play the part of accounts with slots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.customfields import (
    any_slot_in,
    channel_custom_fields,
    channel_filter,
    corrected_transactions,
    field_ids,
    overlay,
    pivot_custom_fields,
    slot_extremes,
)
from tidemark.queries.registry import events, query, stamp, table
from tidemark.sources.reads import distinct_keys, rows_with


def _slots(spark, sf_dir):
    """Line items with three slots; a flag can fill two slots, and some values are null."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
                    F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.col("l_orderkey").cast("string").alias("encoded_key"),
        F.col("l_returnflag").alias("custom_fields_0_id"),
        F.col("l_quantity").cast("int").cast("string").alias("custom_fields_0_value"),
        F.col("l_linestatus").alias("custom_fields_1_id"),
        F.when(F.col("l_discount") > 0.05, F.col("l_suppkey").cast("string")).alias("custom_fields_1_value"),
        F.when(F.col("l_linenumber") < 4, F.col("l_returnflag")).alias("custom_fields_2_id"),
        F.col("l_linenumber").cast("string").alias("custom_fields_2_value"),
    )


SLOTS = """
WITH slots AS (
  SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS id,
         CAST(l_orderkey AS VARCHAR) AS encoded_key,
         l_returnflag AS i0, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS v0,
         l_linestatus AS i1, CASE WHEN l_discount > 0.05 THEN CAST(l_suppkey AS VARCHAR) END AS v1,
         CASE WHEN l_linenumber < 4 THEN l_returnflag END AS i2, CAST(l_linenumber AS VARCHAR) AS v2
  FROM lineitem)
"""


@query(
    "any_slot_filter",
    SLOTS + "SELECT id, i0, i1, i2 FROM slots WHERE i0 IN ('R', 'F') OR i1 IN ('R', 'F') OR i2 IN ('R', 'F')",
)
def any_slot_filter(spark, sf_dir):
    rows = _slots(spark, sf_dir).filter(any_slot_in(("R", "F"), 3))
    return rows.select("id", *[F.col(f"custom_fields_{i}_id").alias(f"i{i}") for i in range(3)])


@query("slot_field_ids", SLOTS + "SELECT i0 AS field_id FROM slots UNION SELECT i1 FROM slots UNION SELECT i2 FROM slots WHERE i2 IS NOT NULL")
def slot_field_ids(spark, sf_dir):
    return field_ids(_slots(spark, sf_dir))


def _pivot_sql(default: str, fill: str) -> str:
    cells = ", ".join(
        f"CASE WHEN i2 = '{f}' THEN {fill.format('v2')} WHEN i1 = '{f}' THEN {fill.format('v1')} "
        f"WHEN i0 = '{f}' THEN {fill.format('v0')} ELSE {default} END AS \"{f}\""
        for f in "AFNOR"
    )
    return SLOTS + f"SELECT id, encoded_key, {cells}, '20240201' AS date FROM slots"


@query("custom_field_pivot", _pivot_sql("'None'", "COALESCE({}, '0')"))
def custom_field_pivot(spark, sf_dir):
    return pivot_custom_fields(_slots(spark, sf_dir), run_date="20240201")


@query("custom_field_pivot_nulls", _pivot_sql("NULL", "{}"))
def custom_field_pivot_nulls(spark, sf_dir):
    return pivot_custom_fields(_slots(spark, sf_dir), list("AFNOR"), run_date="20240201", fill=False)


def _card_events(spark, sf_dir):
    """Events as transactions: the kind is the channel, the properties the first slot."""
    kind = F.col("event_type")
    channel = F.when(kind == "purchase", F.lit("Card_purchase")).when(kind != "error", kind)
    slots = {}
    for i in range(5):
        slots[f"custom_fields_{i}_field_set_id"] = kind
        slots[f"custom_fields_{i}_id"] = F.when(F.col("value") < 5, "").otherwise(kind) if i == 0 else F.lit(f"f{i}")
        slots[f"custom_fields_{i}_value"] = F.col("props")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("encoded_key"),
        channel.alias("transaction_details_transaction_channel_id"),
        *[c.alias(name) for name, c in slots.items()],
        F.date_format("ts", "yyyyMMdd").alias("date"),
        F.col("ts").alias("timestamp_extracted"),
    )


CHANNEL_ROWS = "SELECT event_id AS id, event_type AS kind, strftime(ts, '%Y%m%d') AS date FROM events WHERE event_type IN ('purchase', 'click') AND value >= 5"


@query(
    "channel_filter",
    "SELECT event_id AS id, event_type AS kind FROM events WHERE event_type IN ('purchase', 'click') AND value >= 5",
)
def channel_filter_query(spark, sf_dir):
    rows = _card_events(spark, sf_dir).filter(channel_filter(names=("click",)))
    return rows.select("id", F.col("custom_fields_0_id").alias("kind"))


SLOT_SELECT = ", ".join(
    f"event_type AS custom_fields_{i}_field_set_id, "
    + (f"event_type AS custom_fields_{i}_id" if i == 0 else f"'f{i}' AS custom_fields_{i}_id")
    + f", props AS custom_fields_{i}_value"
    for i in range(5)
)


@query(
    "channel_custom_fields",
    f"""
SELECT event_id AS id, user_id AS encoded_key, {SLOT_SELECT}, strftime(ts, '%Y%m%d') AS date,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp_extracted
FROM events WHERE event_type IN ('purchase', 'click', 'view') AND value >= 5
""",
)
def channel_custom_fields_query(spark, sf_dir):
    rows = channel_custom_fields(_card_events(spark, sf_dir), names=("click", "view"))
    return rows.withColumn("timestamp_extracted", stamp("timestamp_extracted"))


@query(
    "overlay_coalesce",
    """
SELECT p.p_partkey, CASE WHEN p.p_size > 25 THEN p.p_brand ELSE c.p_brand END AS p_brand,
       CASE WHEN p.p_size < 10 THEN c.p_type ELSE p.p_type END AS p_type, p.p_size
FROM part p LEFT JOIN (SELECT p_partkey, lower(p_brand) AS p_brand, lower(p_type) AS p_type FROM part WHERE p_retailprice > 950) c
  ON p.p_partkey = c.p_partkey
""",
)
def overlay_coalesce(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    fixes = part.filter("p_retailprice > 950").select("p_partkey", F.lower("p_brand").alias("p_brand"), F.lower("p_type").alias("p_type"))
    damaged = part.select(
        "p_partkey",
        F.when(F.col("p_size") > 25, F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_size") >= 10, F.col("p_type")).alias("p_type"),
        "p_size",
    )
    return overlay(damaged, fixes, ["p_brand", "p_type"], "p_partkey")


CORRECTED_SLOTS = ", ".join(
    f"'set' AS custom_fields_{i}_field_set_id, "
    f"CASE WHEN event_type = 'error' AND value < 20 THEN NULL WHEN event_type = 'error' THEN 'fixed' ELSE 'f{i}' END AS custom_fields_{i}_id, "
    f"props AS custom_fields_{i}_value"
    for i in range(5)
)


@query(
    "corrected_transactions",
    f"""
SELECT event_id AS transaction_id, {CORRECTED_SLOTS}, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS creation_date,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS value_date, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS booking_date,
       event_type AS type, CAST(-value AS VARCHAR) AS amount, CAST(value AS DECIMAL(10,2)) AS abs_amount,
       'GBP' AS currency_code, strftime(ts, '%Y%m%d') AS date
FROM events
""",
)
def corrected_transactions_query(spark, sf_dir):
    base, error = events(spark, sf_dir), F.col("event_type") == "error"
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    slots = {}
    for i in range(5):
        slots[f"custom_fields_{i}_field_set_id"] = F.lit("set")
        slots[f"custom_fields_{i}_id"] = F.when(~error, F.lit(f"f{i}"))
        slots[f"custom_fields_{i}_value"] = F.col("props")
    primary = base.select(
        F.col("event_id").alias("id"),
        *[c.alias(name) for name, c in slots.items()],
        *[iso.alias(c) for c in ("creation_date", "value_date", "booking_date")],
        F.col("event_type").alias("type"),
        (-F.col("value")).cast("string").alias("amount"),
        F.lit("GBP").alias("currency_code"),
        F.lit(0).alias("account_balances_total_balance"),
        F.lit("x").alias("transaction_details_transaction_channel_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("transfer_details", "branch_key", "transaction_details")],
        F.date_format("ts", "yyyyMMdd").alias("date"),
    )
    fixes = base.filter(error & (F.col("value") >= 20)).select(
        F.col("event_id").alias("id"),
        *[F.lit("fixed" if name.endswith("_id") and "set" not in name else "?").alias(name) for name in slots],
    )
    rows = corrected_transactions(primary, fixes).drop(
        "account_balances_total_balance",
        "transaction_details_transaction_channel_id",
        "transfer_details",
        "branch_key",
        "transaction_details",
    )
    return rows.withColumns({c: stamp(c) for c in ("creation_date", "value_date", "booking_date")})


@query(
    "distinct_slot_ids",
    SLOTS + "SELECT DISTINCT encoded_key, i0, i1, i2 FROM slots WHERE i0 IN ('R', 'A')",
)
def distinct_slot_ids(spark, sf_dir):
    rows = rows_with(_slots(spark, sf_dir), "custom_fields_0_id", ("R", "A"))
    rows = rows.select("encoded_key", *[F.col(f"custom_fields_{i}_id").alias(f"i{i}") for i in range(3)])
    return distinct_keys(rows, *rows.columns)


@query(
    "slot_group_minmax",
    SLOTS
    + """
SELECT i0 AS custom_fields_0_id, i1 AS custom_fields_1_id, i2 AS custom_fields_2_id, MIN(id) AS min_id, MAX(id) AS max_id,
       MIN(encoded_key) AS min_timestamp_extracted, MAX(encoded_key) AS max_timestamp_extracted
FROM slots WHERE v1 IS NOT NULL GROUP BY 1, 2, 3
""",
)
def slot_group_minmax(spark, sf_dir):
    rows = _slots(spark, sf_dir).filter("custom_fields_1_value IS NOT NULL")
    return slot_extremes(rows, 3, seen="encoded_key")
