"""Table catalogs: which type and comment each column of a lake table has.

A catalog is data the user brings: DDL text, a JSON file, or the schema of a table
that exists.  For tables nobody has catalogued, `RULES` types a column from its
name, which is how the wide tables (whose array columns grow with the data) are
covered without listing every column.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type by column name, first match wins; no match is text.
RULES = (
    (r"^custom_fields_\d+_", "string"),
    (r"^(birth_date|balance_to_date)$", "date"),
    (r"(^|_)date$|^timestamp_extracted$|_transaction_time$", "timestamp"),
    (r"(^|_)loan_cycle$|_index_in_list$|^number$|_installments$|_grace_period$", "int"),
    (r"(^|_)(activated|strip_trailing_zeros|enabled|is_payment_holiday|two_factor_authentication)$", "boolean"),
    (r"(^|_)(allow|accrue|has|can_manage)_\w+$|_access$|_internal_transfer$|_advice$", "boolean"),
    (r"(^|_)(amount|balance|due|paid|expected|accrued|interest_rate|spread|fee_amount)$", "double"),
    (r"_amount_(min|max|default)_value$|_overdraft_limit$|_frequency_count$|_review_count$", "double"),
    (r"_(floor|ceiling)_value$|_tolerance_period$|^days_(late|in_arrears)$|_(advance|arrears)_position$", "double"),
)

PARTITION_COLUMN = "date"


def type_of(name: str, rules: Iterable[tuple[str, str]] = RULES) -> str:
    return next((kind for pattern, kind in rules if re.search(pattern, name)), "string")


@dataclass(frozen=True)
class TableCatalog:
    """Column types (as Spark DDL type names) and comments of one table."""

    types: dict[str, str]
    comments: dict[str, str] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(
                    name,
                    T.StructType.fromDDL(f"c {kind}")[0].dataType,
                    True,
                    {"comment": self.comments[name]} if name in self.comments else None,
                )
                for name, kind in self.types.items()
            ]
        )

    def renamed(self, rule) -> TableCatalog:
        """The catalog under another naming rule (catalogs kept in camelCase)."""
        return TableCatalog(
            {rule(k): v for k, v in self.types.items()}, {rule(k): v for k, v in self.comments.items()}
        )


def from_ddl(ddl: str) -> TableCatalog:
    """`"id string COMMENT 'key', amount double"`."""
    return from_schema(T.StructType.fromDDL(ddl))


def from_schema(schema: T.StructType) -> TableCatalog:
    """The catalog an existing table already carries."""
    return TableCatalog(
        {f.name: f.dataType.simpleString() for f in schema},
        {f.name: f.metadata["comment"] for f in schema if "comment" in (f.metadata or {})},
    )


def from_names(names: Iterable[str], overrides: dict[str, str] | None = None) -> TableCatalog:
    """Types by rule, with exceptions given by name."""
    overrides = overrides or {}
    return TableCatalog({name: overrides.get(name) or type_of(name) for name in names})


def read_catalogs(spark: SparkSession, path: str) -> dict[str, TableCatalog]:
    """Catalogs of several tables from one JSON file,
    `{"schemas": {table: {column: type}}, "column_comments": {table: {column: text}}}`."""
    text = spark.read.text(path, wholetext=True).first()[0]
    content = json.loads(text)
    comments = content.get("column_comments", {})
    return {t: TableCatalog(types, comments.get(t, {})) for t, types in content["schemas"].items()}


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments; `saveAsTable` keeps them in the session catalog."""

    def column(name: str) -> Column:
        if name not in comments:
            return F.col(name)
        return F.col(name).alias(name, metadata={"comment": comments[name]})

    return df.select(*[column(name) for name in df.columns])


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def installments() -> TableCatalog:
    """Loan installments: four components, each with an amount and a tax in three measures."""
    return TableCatalog(
        # Columns and types of the table in use.
        {
            "encoded_key": "string",
            "loan_account_id": "string",
            "parent_account_key": "string",
            "number": "string",
            "due_date": "timestamp",
            "state": "string",
            "is_payment_holiday": "boolean",
            "principal_amount_expected": "double",
            "principal_amount_paid": "double",
            "principal_amount_due": "double",
            "interest_amount_expected": "double",
            "interest_amount_paid": "double",
            "interest_amount_due": "double",
            "interest_tax_expected": "double",
            "interest_tax_paid": "double",
            "interest_tax_due": "double",
            "fee_amount_expected": "double",
            "fee_amount_paid": "double",
            "fee_amount_due": "double",
            "fee_tax_expected": "double",
            "fee_tax_paid": "double",
            "fee_tax_due": "double",
            "penalty_amount_expected": "double",
            "penalty_amount_paid": "double",
            "penalty_amount_due": "double",
            "penalty_tax_expected": "double",
            "penalty_tax_paid": "double",
            "penalty_tax_due": "double",
            "custom_fields": "string",
            "last_paid_date": "timestamp",
            "repaid_date": "timestamp",
            "timestamp_extracted": "timestamp",
            "fee_details": "string",
        },
        {
            "encoded_key": "Unique key of the installment",
            "loan_account_id": "Loan account the installment belongs to",
            "due_date": "Day the installment is due",
            "timestamp_extracted": "When the row was extracted from the source",
        },
    )


def slot_catalog(field_ids: Iterable[str]) -> TableCatalog:
    """A pivoted custom-field table: row identity plus one text column per field."""
    return TableCatalog(
        {
            "id": "string",
            "encoded_key": "string",
            "creation_date": "timestamp",
            **{field_id: "string" for field_id in field_ids},
            PARTITION_COLUMN: "string",
        }
    )
