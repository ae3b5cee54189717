"""Documents that carry nested record lists or error lists."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.naming import snake_case, snake_letters
from tidemark.functions.timestamps import parse_catalogued
from tidemark.operators.flatten import Leaf, flatten
from tidemark.operators.leaves import flatten_known
from tidemark.operators.shape import run_time
from tidemark.plans.catalog import TableCatalog, installments
from tidemark.plans.staging import restrict_to_keys
from tidemark.sources.landed import explode_records

# Reasons that only warn.
WARNING_REASONS = ("INVALID_LOAN_ACCOUNT_ID",)


def as_documents(df: DataFrame, column: str) -> DataFrame:
    """The document column as VARIANT; unreadable text becomes null."""
    if isinstance(df.schema[column].dataType, T.VariantType):
        return df
    return df.withColumn(column, F.try_parse_json(column))


def reject_errors(
    df: DataFrame, document: str, records: str, *, warnings: Iterable[str] = WARNING_REASONS
) -> DataFrame:
    """One row per error of the documents that have no record list.

    Rows keep the other columns and get `reason` and `severity`; a document with
    neither records nor errors is rejected without a reason.
    """
    documents = as_documents(df, document)
    keep = [c for c in documents.columns if c != document]
    parts = documents.select(
        *keep,
        F.try_variant_get(document, f"$.{records}", "variant").alias("__records"),
        F.try_variant_get(document, "$.errors", "array<variant>").alias("__errors"),
    )
    # Good documents explode to nothing.  Filtering them out instead would have the
    # optimizer parse each document once more for the filter.
    bad = F.col("__records").isNull() | F.is_variant_null("__records")
    nothing = F.array().cast("array<variant>")
    errors = F.when(~bad, nothing).otherwise(F.coalesce("__errors", F.array(F.lit(None).cast("variant"))))
    rejects = parts.select(*keep, F.explode(errors).alias("__error"))
    reason = F.try_variant_get("__error", "$.errorReason", "string")
    severity = F.when(reason.isin(*warnings), "warning").otherwise("error")
    return rejects.select(*keep, reason.alias("reason"), severity.alias("severity"))


def records_of(
    df: DataFrame,
    document: str,
    records: str,
    *,
    leaves: list[Leaf] | None = None,
    run_ts: datetime | None = None,
    **find_options,
) -> DataFrame:
    """One flat row per element of the documents' record list; empty containers become ''.

    Documents without the list, such as error documents, give no rows.
    """
    rows = explode_records(as_documents(df, document), document, [records])
    flat = flatten(rows, "record", leaves, empty_as="", **find_options)
    return flat.withColumn("timestamp_extracted", run_time(run_ts)) if run_ts else flat


def installments_known(
    documents: DataFrame,
    accounts: DataFrame,
    registry: str,
    *,
    account_id: str = "loan_account_id",
    document: str = "document",
    run_ts: datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """`installments_for` with the leaf paths of earlier runs, kept in `registry`.

    Once the paths are known each document is read and parsed once: records and the
    errors of documents without any come out of one staged pass.
    """
    ids = accounts.select(F.col("id").alias(account_id))
    wanted = as_documents(restrict_to_keys(documents, ids, [account_id]), document)
    keep = [c for c in wanted.columns if c != document]
    parts = wanted.select(
        *keep,
        F.try_variant_get(document, "$.installments", "variant").alias("__records"),
        F.transform(F.try_variant_get(document, "$.errors", "array<variant>"), lambda e: F.try_variant_get(e, "$.errorReason", "string")).alias("__reasons"),
    )
    missing = F.col("__records").isNull() | F.is_variant_null("__records")
    reasons = F.when(missing, F.coalesce("__reasons", F.array(F.lit(None).cast("string"))))
    parts = parts.withColumn("__reasons", reasons)
    elements = wanted.sparkSession.tvf.variant_explode_outer(F.col("__records").outer()).toDF("__pos", "__key", "record")
    rows = parts.lateralJoin(elements)
    # A row for each element of a list, and one for each document without records.
    rows = rows.withColumn("__element", F.col("__pos").isNotNull() & F.col("__key").isNull())
    rows = rows.select(*keep, "__reasons", "__element", F.when(F.col("__element"), F.col("record")).alias("record"))
    told = flatten_known(rows, "record", registry, empty_as="", only="__element")
    flat = told.filter("__element").drop("__reasons", "__element")
    severity = F.when(F.col("reason").isin(*WARNING_REASONS), "warning").otherwise("error")
    rejects = told.filter("NOT __element").select(*keep, F.explode("__reasons").alias("reason")).withColumn("severity", severity)
    return (flat.withColumn("timestamp_extracted", run_time(run_ts)) if run_ts else flat), rejects


def installments_for(
    documents: DataFrame,
    accounts: DataFrame,
    *,
    account_id: str = "loan_account_id",
    document: str = "document",
    run_ts: datetime | None = None,
    leaves: list[Leaf] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The installments of the accounts listed, and the rejected documents.

    `accounts` has the ids in a column `id`; it may repeat them.
    """
    ids = accounts.select(F.col("id").alias(account_id))
    wanted = restrict_to_keys(documents, ids, [account_id])
    flat = records_of(wanted, document, "installments", leaves=leaves, run_ts=run_ts)
    return flat, reject_errors(wanted, document, "installments")


def installment_table(flat: DataFrame, catalog: TableCatalog | None = None) -> DataFrame:
    """Column names by letter, and the catalogued timestamps parsed."""
    catalog = catalog or installments()
    return parse_catalogued(snake_case(flat, snake_letters), catalog.types)


def product_configurations(
    documents: DataFrame, document: str = "document", run_ts: datetime | None = None, leaves: list[Leaf] | None = None
) -> DataFrame:
    """One flat, snake-cased row per product of the configuration documents."""
    return snake_case(records_of(documents, document, "loanProducts", run_ts=run_ts, leaves=leaves), snake_letters)
