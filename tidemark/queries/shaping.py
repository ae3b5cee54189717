"""Flattening, cleaning, naming and typing queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.naming import rename_in_order, snake_case, snake_letters_column, snake_words_column
from tidemark.functions.text import clean_columns
from tidemark.functions.timestamps import (
    ISO_MICROS,
    add_second_text,
    calendar_day,
    day_text,
    iso_text,
    parse_catalogued,
    parse_timestamp_column,
)
from tidemark.operators.documents import installment_table, installments_for, product_configurations, reject_errors
from tidemark.operators.flatten import blank_empty, flatten
from tidemark.operators.shape import add_meta, drop_null_columns, record_table
from tidemark.operators.typing import apply_types, boolean_or_text, infer_types
from tidemark.plans.catalog import TableCatalog
from tidemark.plans.ingest import process_records, process_response
from tidemark.queries.registry import events, query, stamp, table
from tidemark.sources.landed import select_objects

RUN_TS = datetime(2024, 2, 1, 1, 0)


@query(
    "flatten_json_props",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def flatten_json_props(spark, sf_dir):
    flat = flatten(events(spark, sf_dir).select("event_id", "props"), "props")
    return flat.withColumn("k", F.col("k").cast("bigint"))


def _order_records(spark, sf_dir):
    """Orders as nested JSON records: structs, a list, empty containers, false and zero."""
    record = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("orderKey"),
            F.struct(
                F.struct(F.col("o_totalprice").alias("due"), F.lit(0).alias("paid")).alias("amount"),
                (F.col("o_orderstatus") == "F").alias("closed"),
            ).alias("total"),
            F.when(F.col("o_orderstatus") == "P", F.array().cast("array<string>"))
            .when(F.col("o_orderstatus") == "O", F.array("o_orderpriority"))
            .otherwise(F.array("o_orderstatus", "o_orderpriority"))
            .alias("tags"),
        )
    )
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), record.alias("record"))


@query(
    "flatten_nested_records",
    """
SELECT o_orderkey AS id, o_orderkey AS "orderKey", o_totalprice AS total_amount_due, '0' AS total_amount_paid,
       CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS total_closed,
       CASE WHEN o_orderstatus = 'P' THEN '[]' END AS tags,
       CASE o_orderstatus WHEN 'O' THEN o_orderpriority WHEN 'F' THEN 'F' END AS tags_0,
       CASE o_orderstatus WHEN 'F' THEN o_orderpriority END AS tags_1
FROM orders
""",
)
def flatten_nested_records(spark, sf_dir):
    flat = flatten(_order_records(spark, sf_dir), "record")
    return flat.withColumns(
        {"orderKey": F.col("orderKey").cast("bigint"), "total_amount_due": F.col("total_amount_due").cast("double")}
    )


@query(
    "blank_empty_containers",
    "SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN '' END AS tags FROM orders",
)
def blank_empty_containers(spark, sf_dir):
    return blank_empty(flatten(_order_records(spark, sf_dir), "record").select("id", "tags"), "tags")


@query(
    "embedded_json",
    """
SELECT event_id AS id, CAST(event_id AS VARCHAR) AS "eventId", event_type AS kind,
       json_extract_string(props, '$.k') AS props_k FROM events
""",
)
def embedded_json(spark, sf_dir):
    record = F.to_json(
        F.struct(F.col("event_id").alias("eventId"), F.col("event_type").alias("kind"), F.col("props"))
    )
    rows = events(spark, sf_dir).select(F.col("event_id").alias("id"), record.alias("record"))
    return flatten(rows, "record", embedded=True)


@query(
    "process_response",
    """
SELECT doc_id, CAST(doc_id AS VARCHAR) AS entry_id, lang AS entry_lang,
       replace(translate(text, chr(10) || chr(13) || chr(9), '   '), '  ', ' ') AS entry_text FROM documents
""",
)
def process_response_query(spark, sf_dir):
    entry = F.struct(F.col("doc_id").alias("id"), "lang", "text")
    document = F.to_json(F.struct(F.struct(entry.alias("entry")).alias("data"), F.lit("x").alias("other")))
    rows = table(spark, sf_dir, "documents").select("doc_id", document.alias("document"))
    return process_response(rows, "document", keys=("data",), clean=True, flat=True)


@query(
    "select_objects",
    """
SELECT event_id, event_type AS one, CAST(value AS VARCHAR) AS two_value, CAST(NULL AS VARCHAR) AS two_absent FROM events
""",
)
def select_objects_query(spark, sf_dir):
    record = F.parse_json(
        F.to_json(F.struct("event_type", F.col("value").cast("string").alias("value"), F.lit(1).alias("rest")))
    )
    rows = events(spark, sf_dir).select("event_id", record.alias("d"))
    picked = rows.select(
        "event_id",
        select_objects(F.col("d"), ["event_type"]).cast("string").alias("one"),
        select_objects(F.col("d"), ["value", "absent"]).alias("two"),
    )
    return picked.select(
        "event_id",
        "one",
        F.try_variant_get("two", "$.value", "string").alias("two_value"),
        F.try_variant_get("two", "$.absent", "string").alias("two_absent"),
    )


@query(
    "record_table",
    """
SELECT o_orderkey AS id, '[' || '"' || o_orderstatus || '","' || o_orderpriority || '"]' AS tags, '20240201' AS date,
       '2024-02-01 01:00:00.000000' AS timestamp_extracted FROM orders
""",
)
def record_table_query(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.array("o_orderstatus", "o_orderpriority").alias("tags")
    )
    return record_table(rows, RUN_TS, flat=False).withColumn("timestamp_extracted", stamp("timestamp_extracted"))


CLEAN = "replace(translate(text, chr(10) || chr(13) || chr(9), '   '), '  ', ' ')"


@query("clean_text", f"SELECT doc_id, {CLEAN} AS text FROM documents")
def clean_documents(spark, sf_dir):
    return clean_columns(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


@query("clean_conversations", f"SELECT conv_id, turn, role, {CLEAN} AS text FROM conversations")
def clean_conversations(spark, sf_dir):
    return clean_columns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


@query(
    "multi_format_ts",
    """
WITH e AS (SELECT event_id, date_trunc('second', ts) AS t FROM events)
SELECT event_id, strftime(CASE
    WHEN event_id % 6 = 0 THEN t - INTERVAL 3 HOUR
    WHEN event_id % 6 = 4 AND day(t) <= 12
      THEN make_timestamp(year(t), day(t), month(t), hour(t), minute(t), second(t))
    WHEN event_id % 6 = 5 THEN NULL
    ELSE t END, '%Y-%m-%d %H:%M:%S.%f') AS parsed
FROM e
""",
)
def multi_format_ts(spark, sf_dir):
    """Every event time, written in one of the accepted layouts (or as empty text), read back."""
    moment, turn = F.date_trunc("second", "ts"), F.col("event_id") % 6
    text = (
        F.when(turn == 0, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'+03:00'"))
        .when(turn == 1, F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
        .when(turn == 2, F.date_format(moment, "M/d/yyyy h:mm:ss a"))
        .when(turn == 3, F.date_format(moment, "dd-MM-yyyy HH:mm:ss"))
        .when(turn == 4, F.date_format(moment, "yyyy-dd-MM HH:mm:ss"))
        .otherwise("")
    )
    rows = events(spark, sf_dir).select("event_id", text.alias("text"))
    return rows.select("event_id", stamp(parse_timestamp_column(rows, "text")).alias("parsed"))


@query(
    "fixed_format_ts",
    """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS again,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
""",
)
def fixed_format_ts(spark, sf_dir):
    written = events(spark, sf_dir).select("event_id", iso_text(F.col("ts")).alias("ts"))
    parsed = parse_catalogued(written, {"ts": "timestamp"}, ISO_MICROS)
    return parsed.select("event_id", iso_text(F.col("ts")).alias("again"), stamp("ts").alias("ts"))


@query(
    "scalar_functions",
    """
SELECT event_id, CAST(ts AS DATE) AS day_of_text, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') AS midnight,
       strftime(ts, '%Y%m%d') AS partition_day, CAST(ts AS DATE) - 1 AS day_before,
       abs(CAST(-value AS DECIMAL(10,2))) AS abs_amount, starts_with(event_type, 'p') AND length(event_type) > 0 AS is_card,
       CASE WHEN event_type = 'error' THEN 'none' ELSE event_type END AS filled,
       strftime(least(ts + INTERVAL 1 SECOND, TIMESTAMP '2024-01-15 00:00:00'), '%Y-%m-%dT%H:%M:%S.%fZ') AS chunk_end
FROM events
""",
)
def scalar_functions(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("text", iso_text(F.col("ts")))
    return rows.select(
        "event_id",
        calendar_day(rows, "text").alias("day_of_text"),
        stamp(F.date_trunc("day", "ts")).alias("midnight"),
        day_text(F.col("ts")).alias("partition_day"),
        F.to_date(F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("day_before"),
        F.abs((-F.col("value")).cast("decimal(10,2)")).alias("abs_amount"),
        (F.col("event_type").startswith("p") & (F.length("event_type") > 0)).alias("is_card"),
        F.coalesce(F.when(F.col("event_type") != "error", F.col("event_type")), F.lit("none")).alias("filled"),
        F.least(add_second_text(F.col("text")), F.lit("2024-01-15T00:00:00.000000Z")).alias("chunk_end"),
    )


@query(
    "coerce_schema",
    """
SELECT p_partkey AS id, CASE WHEN p_size > 45 THEN 0 ELSE p_size END AS size,
       CASE WHEN p_type = 'PROMO' THEN 0.0 ELSE p_retailprice END AS price,
       CAST(CASE WHEN p_size > 45 THEN 0 ELSE p_partkey * 100000 END AS BIGINT) AS big,
       p_size > 25 AS large, p_name AS name
FROM part
""",
)
def coerce_schema(spark, sf_dir):
    junk = F.col("p_size") > 45
    text = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.when(junk, "n/a").otherwise(F.col("p_size").cast("string")).alias("size"),
        F.when(F.col("p_type") != "PROMO", F.col("p_retailprice").cast("string")).alias("price"),
        F.when(junk, "").otherwise((F.col("p_partkey") * 100000).cast("string")).alias("big"),
        F.when(F.col("p_size") > 25, "true").otherwise("False").alias("large"),
        F.col("p_name").alias("name"),
    )
    kinds = {"id": "bigint", "size": "int", "price": "double", "big": "bigint", "large": "boolean", "name": "string"}
    return apply_types(text, kinds)


@query(
    "infer_types",
    """
SELECT 'key' AS column_name, CASE WHEN MAX(c_custkey) < 2147483648 THEN 'int' ELSE 'bigint' END AS type FROM customer
UNION ALL SELECT 'big', CASE WHEN MAX(c_custkey) + 5000000000 < 2147483648 THEN 'int' ELSE 'bigint' END FROM customer
UNION ALL SELECT 'balance', CASE WHEN COUNT(*) FILTER (c_acctbal <> floor(c_acctbal)) > 0 THEN 'double' ELSE 'int' END FROM customer
UNION ALL SELECT 'debtor', CASE WHEN COUNT(c_acctbal) = COUNT(*) THEN 'boolean' ELSE 'string' END FROM customer
UNION ALL SELECT 'segment', CASE WHEN MIN(c_mktsegment) > 'A' THEN 'string' ELSE 'int' END FROM customer
UNION ALL SELECT 'date', CASE WHEN COUNT(*) > 0 THEN 'string' END FROM customer
UNION ALL SELECT 'sparse', CASE WHEN COUNT(*) FILTER (c_acctbal < 0) > 0 THEN 'int' ELSE 'string' END FROM customer
""",
)
def infer_types_query(spark, sf_dir):
    text = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("key"),
        (F.col("c_custkey") + 5_000_000_000).cast("string").alias("big"),
        F.col("c_acctbal").cast("string").alias("balance"),
        (F.col("c_acctbal") < 0).cast("string").alias("debtor"),
        F.col("c_mktsegment").alias("segment"),
        F.lit("20240101").alias("date"),
        F.when(F.col("c_acctbal") < 0, F.col("c_nationkey").cast("string")).otherwise("None").alias("sparse"),
    )
    return spark.createDataFrame(list(infer_types(text).items()), "column_name string, type string")


@query(
    "infer_event_types",
    """
SELECT 'ts' AS column_name,
       CASE WHEN COUNT(*) FILTER (ts <> date_trunc('day', ts)) > 0 THEN 'timestamp' ELSE 'date' END AS type FROM events
UNION ALL SELECT 'day', CASE WHEN COUNT(*) > 0 THEN 'date' END FROM events
UNION ALL SELECT 'user_id', CASE WHEN MAX(user_id) < 2147483648 THEN 'int' ELSE 'bigint' END FROM events
UNION ALL SELECT 'props', CASE WHEN MIN(props) LIKE '{%' THEN 'string' END FROM events
""",
)
def infer_event_types(spark, sf_dir):
    text = events(spark, sf_dir).select(
        iso_text(F.col("ts")).alias("ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.col("user_id").cast("string").alias("user_id"),
        "props",
    )
    return spark.createDataFrame(list(infer_types(text).items()), "column_name string, type string")


@query(
    "snake_case_names",
    r"""
WITH n AS (SELECT p_partkey, '_' || p_brand || upper(substr(p_name, 1, 3)) || p_type || 'Iban' || upper(substr(p_name, 4, 1)) || 'code__Id_' AS name FROM part)
SELECT p_partkey, name,
       lower(trim(regexp_replace(regexp_replace(regexp_replace(name, '([a-z])([A-Z])', '\1_\2', 'g'),
             '([A-Z]+)([A-Z][a-z])', '\1_\2', 'g'), '_+', '_', 'g'), '_')) AS words,
       ltrim(lower(regexp_replace(name, '([A-Z])', '_\1', 'g')), '_') AS letters
FROM n
""",
)
def snake_case_names(spark, sf_dir):
    name = F.concat(
        F.lit("_"),
        "p_brand",
        F.upper(F.substring("p_name", 1, 3)),
        "p_type",
        F.lit("Iban"),
        F.upper(F.substring("p_name", 4, 1)),
        F.lit("code__Id_"),
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))
    return rows.withColumns(
        {"words": snake_words_column(F.col("name")), "letters": snake_letters_column(F.col("name"))}
    )


@query(
    "renamed_columns",
    "SELECT o_orderkey AS order_id, o_custkey AS account_key, o_orderstatus AS iban_state FROM orders",
)
def renamed_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderKey"),
        F.col("o_custkey").alias("accountKey"),
        F.col("o_orderstatus").alias("IBANState"),
    )
    return rename_in_order(snake_case(rows), [{"order_key": "id"}, {"id": "order_id", "absent": "x"}])


@query(
    "meta_columns",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate, strftime(o_orderdate, '%Y%m%d') AS date,
       '2024-02-01 01:00:00.000000' AS timestamp_extracted FROM orders
""",
)
def meta_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"))
    stamped = add_meta(rows, RUN_TS, "o_orderdate")
    return stamped.withColumns({c: stamp(c) for c in ("o_orderdate", "timestamp_extracted")})


@query("null_columns_dropped", "SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice > 400000 THEN 'big' END AS rare FROM orders")
def null_columns_dropped(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_totalprice") > 400000, "big").alias("rare"),
        F.when(F.col("o_totalprice") < 0, "negative").alias("never"),
    )
    return drop_null_columns(rows)


@query(
    "boolean_or_text",
    """
SELECT c_custkey, c_acctbal < 0 AS access_overdraft,
       CASE WHEN c_nationkey = 3 THEN 'partly' ELSE 'true' END AS access_branch,
       c_mktsegment = 'BUILDING' AS active FROM customer
""",
)
def boolean_or_text_query(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") < 0).cast("string").alias("access_overdraft"),
        F.when(F.col("c_nationkey") == 3, "partly").otherwise("true").alias("access_branch"),
        (F.col("c_mktsegment") == "BUILDING").cast("string").alias("active"),
    )
    return boolean_or_text(rows, {"c_custkey": "bigint", "active": "boolean"})


PROCESSED = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS amount, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS creation_date,
       o_orderstatus AS order_state, strftime(o_orderdate, '%Y%m%d') AS date FROM orders
"""


def _api_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("encodedKey"),
        F.col("o_totalprice").cast("string").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("creationDate"),
        F.col("o_orderstatus").alias("orderState"),
        F.lit(None).cast("string").alias("notUsed"),
    )


@query("process_records_catalogued", PROCESSED)
def process_records_catalogued(spark, sf_dir):
    catalog = TableCatalog({"id": "string", "amount": "double", "creation_date": "timestamp", "date": "string"})
    shaped, _ = process_records(
        _api_orders(spark, sf_dir), RUN_TS, cdc_field="creationDate", renames=({"encoded_key": "id"},), catalog=catalog
    )
    return shaped.withColumn("creation_date", stamp("creation_date")).drop("timestamp_extracted")


@query("process_records_inferred", PROCESSED.replace("CAST(o_orderkey AS VARCHAR) AS id", "CAST(o_orderkey AS INTEGER) AS id"))
def process_records_inferred(spark, sf_dir):
    shaped, _ = process_records(
        _api_orders(spark, sf_dir), RUN_TS, cdc_field="creationDate", renames=({"encoded_key": "id"},)
    )
    # Order dates are whole days, which is what the inference finds.
    return shaped.withColumn("creation_date", stamp("creation_date")).drop("timestamp_extracted")


def _schedule_documents(spark, sf_dir, orders=None):
    """One document per order: a schedule of up to three installments, or errors."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'")
    part = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), (F.col("o_custkey") % 4).cast("int"))),
        lambda i: F.struct(
            F.concat_ws("-", F.col("o_orderkey").cast("string"), i.cast("string")).alias("encodedKey"),
            i.cast("string").alias("number"),
            day.alias("dueDate"),
            F.struct(F.struct(F.col("o_totalprice").alias("due")).alias("amount")).alias("principal"),
            (F.col("o_orderstatus") == "F").alias("isPaymentHoliday"),
            F.array().cast("array<string>").alias("feeDetails"),
        ),
    )
    reason = F.when(F.col("o_orderpriority") == "5-LOW", "INVALID_LOAN_ACCOUNT_ID").otherwise("LOCKED")
    good = F.to_json(F.struct(part.alias("installments")))
    bad = F.to_json(F.struct(F.array(F.struct(reason.alias("errorReason"))).alias("errors")))
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    return orders.select(
        F.col("o_orderkey").cast("string").alias("loan_account_id"),
        F.when(F.col("o_orderstatus") == "P", bad).otherwise(good).alias("document"),
    )


@query(
    "explode_installments",
    """
SELECT CAST(o_orderkey AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS encoded_key, CAST(i AS VARCHAR) AS number,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS due_date, o_totalprice AS principal_amount_due,
       CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS is_payment_holiday, '' AS fee_details,
       CAST(o_orderkey AS VARCHAR) AS loan_account_id
FROM (SELECT *, UNNEST(generate_series(1, greatest(1, o_custkey % 4))) AS i FROM orders
      WHERE o_orderstatus <> 'P' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'))
""",
)
def explode_installments(spark, sf_dir):
    accounts = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    accounts = accounts.select(F.col("l_orderkey").cast("string").alias("id"))
    flat, _ = installments_for(_schedule_documents(spark, sf_dir), accounts, run_ts=RUN_TS)
    rows = installment_table(flat)
    return rows.withColumns(
        {"due_date": stamp("due_date"), "principal_amount_due": F.col("principal_amount_due").cast("double")}
    ).drop("timestamp_extracted")


@query(
    "error_split",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS loan_account_id,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'INVALID_LOAN_ACCOUNT_ID' ELSE 'LOCKED' END AS reason,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'warning' ELSE 'error' END AS severity
FROM orders WHERE o_orderstatus = 'P'
""",
)
def error_split(spark, sf_dir):
    return reject_errors(_schedule_documents(spark, sf_dir), "document", "installments")


@query(
    "product_configurations",
    """
SELECT CAST(p_partkey AS VARCHAR) AS part, p_name AS product_name, CAST(p_size AS VARCHAR) AS loan_amount_settings_max,
       '' AS templates, p_brand AS brand FROM part
UNION ALL
SELECT CAST(p_partkey AS VARCHAR), p_name, '0', '', p_brand FROM part
""",
)
def product_configurations_query(spark, sf_dir):
    def product(size):
        return F.struct(
            F.col("p_name").alias("productName"),
            F.struct(F.struct(size.alias("max")).alias("amountSettings")).alias("loan"),
            F.array().cast("array<string>").alias("templates"),
            F.col("p_brand").alias("Brand"),
        )

    document = F.to_json(F.struct(F.array(product(F.col("p_size")), product(F.lit(0))).alias("loanProducts")))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("part"), document.alias("document"))
    return product_configurations(rows)
