"""Landed JSON: one record per line, or documents that hold records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_lines(spark: SparkSession, folder: str, stream: str) -> DataFrame | None:
    """All `<stream>*.jsonl` records as a text column `record`; None when no file is there."""
    try:
        lines = spark.read.text(f"{folder}/{stream}*.jsonl")
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return lines.filter(F.length(F.btrim("value")) > 0).select(F.col("value").alias("record"))


def step(key: str | int) -> str | None:
    """One step of a VARIANT path; None for a key no path can spell, which holds both kinds of quotes."""
    if isinstance(key, int):
        return f"[{key}]"
    quote = next((q for q in ("'", '"') if q not in key), None)
    return quote and f"[{quote}{key}{quote}]"


def value_at(document: Column, keys: Iterable[str | int], kind: str) -> Column:
    """What stands under a chain of keys and indexes of a VARIANT, as `kind`; null where it is not there."""
    path = "$"
    for key in keys:
        spelt = step(key)
        if spelt is None:
            fields = F.try_variant_get(document, path, "map<string,variant>")
            document, path = F.try_element_at(fields, F.lit(key)), "$"
        else:
            path += spelt
    return F.try_variant_get(document, path, kind)


def select_objects(document: Column, keys: Iterable[str]) -> Column:
    """From a VARIANT document: one key gives its value, several give the sub-object of
    the keys that are present."""
    keys = list(keys)

    def child(key: str) -> Column:
        return value_at(document, [key], "variant")

    if not keys:
        return document
    if len(keys) == 1:
        return child(keys[0])
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), child(k).alias("value")) for k in keys])
    present = F.filter(pairs, lambda pair: pair["value"].isNotNull())
    return F.to_variant_object(F.map_from_entries(present))


def explode_records(df: DataFrame, document: str, keys: Iterable[str], record: str = "record") -> DataFrame:
    """One row per element of the array under `keys`; the document's other columns stay."""
    keep = [c for c in df.columns if c != document]
    rows = df.select(*keep, select_objects(F.col(document), keys).alias("__items"))
    elements = df.sparkSession.tvf.variant_explode(F.col("__items").outer()).toDF("__pos", "__key", record)
    # Elements of an array have no key.
    return rows.lateralJoin(elements).filter(F.col("__key").isNull()).select(*keep, record)
