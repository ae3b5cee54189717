"""Custom fields: numbered slots that each hold a field id and a value."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import fill_missing

# The field ids and channels the stock jobs select.
CLIENT_FIELDS = (
    "CC_AccNoOrIBAN",
    "CC_BicOrRoutingCode",
    "_CC_contactId",
    "_CC_subAccountId",
    "Fee_Override",
    "Override_Expiry_Date",
)
DEPOSIT_ACCOUNT_FIELDS = (
    "CBS_accountNumber",
    "CBS_assignedDepositUser",
    "CBS_ibanDeposit",
    "CBS_mandatesDetails",
    "CBS_sortCode",
    "CBS_virtualAccountId",
    "FTD_CLOSING_BALANCE",
    "FTD_CLOSING_PROFIT",
    "term_id",
)
TRANSFER_CHANNELS = ("Wise_Local_Payments", "Paymentology-FastLite")
CARD_PREFIX = "Card_"
CHANNEL_COLUMN = "transaction_details_transaction_channel_id"
# What the pivot writes for an empty cell, and for a field a row does not have.
NO_VALUE, NO_FIELD = "0", "None"


def slot_columns(slots: int, part: str) -> list[str]:
    return [f"custom_fields_{i}_{part}" for i in range(slots)]


def present_slots(df: DataFrame, slots: int) -> list[int]:
    """The slots the table really has; the others are ignored."""
    return [i for i in range(slots) if {f"custom_fields_{i}_id", f"custom_fields_{i}_value"} <= set(df.columns)]


def any_slot_in(ids: Sequence[str], slots: int = 4) -> Column:
    """True where any of the slots holds one of the field ids."""
    return reduce(or_, [F.col(c).isin(*ids) for c in slot_columns(slots, "id")])


def channel_filter(
    channel: str = CHANNEL_COLUMN,
    names: Iterable[str] = TRANSFER_CHANNELS,
    prefix: str = CARD_PREFIX,
    first_slot: str = "custom_fields_0_id",
) -> Column:
    """Rows of the named channels or with the channel prefix that have a first custom field."""
    known = F.col(channel).isin(*names) | F.col(channel).startswith(prefix)
    return F.coalesce(known, F.lit(False)) & F.coalesce(F.length(first_slot) > 0, F.lit(False))


def slot_projection(df: DataFrame, slots: int = 5) -> DataFrame:
    """Row identity, the slots, and the load columns."""
    fields = [f"custom_fields_{i}_{part}" for i in range(slots) for part in ("field_set_id", "id", "value")]
    return df.select("id", "encoded_key", *fields, "date", "timestamp_extracted")


def channel_custom_fields(df: DataFrame, slots: int = 5, **filter_options) -> DataFrame:
    """The custom-field extraction job: filter channels, keep the slot columns."""
    return slot_projection(df.filter(channel_filter(**filter_options)), slots)


def field_ids(df: DataFrame, slots: int = 8) -> DataFrame:
    """The distinct field ids over all slots, in one scan."""
    ids = F.array(*[F.col(f"custom_fields_{i}_id") for i in present_slots(df, slots)])
    return df.select(F.explode(ids).alias("field_id")).filter(F.col("field_id").isNotNull()).distinct()


def pivot_custom_fields(
    df: DataFrame,
    ids: Sequence[str] | None = None,
    *,
    slots: int = 8,
    run_date: str | None = None,
    fill: bool = True,
    max_fields: int | None = None,
) -> DataFrame:
    """One text column per field id; of several slots with one id, the last counts.

    This is a projection of each row, so it needs no shuffle.  When `ids` is None the
    field ids present are looked up first, with one distinct over the slots.
    `fill=True` writes "0" for empty cells and "None" for fields a row lacks, as the
    existing tables have it; `fill=False` leaves nulls.
    """
    used = present_slots(df, slots)
    if ids is None:
        found = [row.field_id for row in field_ids(df, slots).transform(lambda d: d if max_fields is None else d.limit(max_fields + 1)).collect()]
        if max_fields is not None and len(found) > max_fields:
            raise ValueError(f"more than {max_fields} field ids; raise max_fields")
        ids = sorted(found)
    ids = [field_id for field_id in ids if field_id != NO_VALUE]
    filled = fill_missing(df, NO_VALUE) if fill else df
    # Last slot first, so that the first match is the one that counts.
    names = F.array(*[F.col(f"custom_fields_{i}_id") for i in reversed(used)])
    values = F.array(*[F.col(f"custom_fields_{i}_value") for i in reversed(used)])
    slot_parts = {f"custom_fields_{i}_{part}" for i in used for part in ("id", "value")}
    base = [c for c in filled.columns if c not in slot_parts]
    prepared = filled.select(*base, names.alias("__ids"), values.alias("__values"))

    def cell(field_id: str) -> Column:
        value = F.get("__values", F.array_position("__ids", F.lit(field_id)).cast("int") - 1)
        return (F.coalesce(value, F.lit(NO_FIELD)) if fill else value).alias(field_id)

    wide = prepared.select(*base, *[cell(field_id) for field_id in ids])
    return wide.withColumn("date", F.lit(run_date)) if run_date else wide


def overlay(primary: DataFrame, correction: DataFrame, columns: Sequence[str], key: str = "id") -> DataFrame:
    """All primary rows; where one of `columns` is null, the correction's value.

    An ordinary key join: null keys do not match, and a correction that repeats a
    key repeats the row.  No side is broadcast unless its size is known to be small;
    both sides reach the join as they are, so AQE can split a hot primary key.
    """
    fixes = correction.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__fix_{c}") for c in columns])
    joined = primary.join(fixes, primary[key] == fixes["__key"], "left")
    patched = set(columns)
    return joined.select(
        *[F.coalesce(F.col(c), F.col(f"__fix_{c}")).alias(c) if c in patched else F.col(c) for c in primary.columns]
    )


def corrected_transactions(primary: DataFrame, correction: DataFrame, slots: int = 5) -> DataFrame:
    """The reporting view of transactions with their slot columns corrected."""
    fields = [f"custom_fields_{i}_{part}" for i in range(slots) for part in ("field_set_id", "id", "value")]
    times = ("creation_date", "value_date", "booking_date")
    patched = overlay(primary, correction, fields)
    rest = [
        "account_balances_total_balance",
        CHANNEL_COLUMN,
        "transfer_details",
        "branch_key",
        "transaction_details",
    ]
    return patched.select(
        F.col("id").alias("transaction_id"),
        *fields,
        *[F.to_timestamp(F.col(c)).alias(c) for c in times],
        "type",
        "amount",
        F.abs(F.col("amount").cast("decimal(10,2)")).alias("abs_amount"),
        "currency_code",
        *rest,
        "date",
    )


def slot_extremes(df: DataFrame, slots: int = 5, id_column: str = "id", seen: str = "timestamp_extracted") -> DataFrame:
    """First and last id (as text) and extraction time per combination of slot ids."""
    return df.groupBy(*slot_columns(slots, "id")).agg(
        F.min(F.col(id_column).cast("string")).alias("min_id"),
        F.max(F.col(id_column).cast("string")).alias("max_id"),
        F.min(seen).alias("min_timestamp_extracted"),
        F.max(seen).alias("max_timestamp_extracted"),
    )
