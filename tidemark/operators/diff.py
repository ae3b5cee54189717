"""Key comparison between a source and the lake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.staging import restrict_to_keys

# Where a key was found.
SOURCE_ONLY, TARGET_ONLY, BOTH = "left_only", "right_only", "both"


def _tagged(df: DataFrame, keys: list[str], in_source: bool) -> DataFrame:
    return df.select(*keys, F.lit(in_source).alias("__s"), F.lit(not in_source).alias("__t"))


def compare_keys(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Every distinct key of either side, with `provenance` telling where it is.

    A full outer join of two distinct key sets, written as one grouping of their
    union: one shuffle of keys instead of four, repeated keys collapse before it, and
    null keys match each other as they do in the source system's comparison.
    """
    both_sides = _tagged(source, keys, True).unionByName(_tagged(target, keys, False))
    found = both_sides.groupBy(*keys).agg(F.max("__s").alias("__s"), F.max("__t").alias("__t"))
    provenance = F.when(F.col("__s") & F.col("__t"), BOTH).when(F.col("__s"), SOURCE_ONLY).otherwise(TARGET_ONLY)
    return found.select(*keys, provenance.alias("provenance"))


def keys_found(compared: DataFrame, where: str) -> DataFrame:
    """The keys of one part of the three-way split."""
    return compared.filter(F.col("provenance") == where).drop("provenance")


def provenance_counts(compared: DataFrame) -> DataFrame:
    return compared.groupBy("provenance").agg(F.count("*").alias("keys"))


def missing_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Whole source rows whose key the target lacks.

    Only keys are shuffled to find what is missing; the wide rows are then filtered
    in place (see `restrict_to_keys`).
    """
    missing = keys_found(compare_keys(source, target, keys), SOURCE_ONLY)
    return restrict_to_keys(source, missing, keys, null_safe=True)


def missing_versions(
    source: DataFrame, target: DataFrame, keys: list[str], parsed: dict[str, Column] | None = None
) -> DataFrame:
    """Anti-join on several keys after bringing some of them to the target's type."""
    return missing_rows(source.withColumns(parsed) if parsed else source, target, keys)
