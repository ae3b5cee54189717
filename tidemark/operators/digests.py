"""Key comparison by digests first: sums of hashes per day and bucket, keys only where these differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timestamps import calendar_day
from tidemark.operators.diff import BOTH, SOURCE_ONLY, TARGET_ONLY
from tidemark.plans.staging import stage

BUCKETS = 256
PLACE = ["day", "bucket"]
HALF = 0xFFFFFFFF


def _placed(rows: DataFrame, keys: list[str], day: Column, buckets: int) -> DataFrame:
    """keys, day and bucket of each row; keys that compare equal as they are hash equal."""
    return rows.select(*keys, day.alias("day"), F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"))


def key_digests(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Per (day, bucket): rows and order-free sums of two 64-bit hashes of the keys.

    Each hash is summed in two halves, which stay within a long for two billion rows.
    Digests of parts of a table add up to that of the whole.
    """
    first, second = F.xxhash64(*keys), F.xxhash64(F.lit(1), *keys)
    return placed.groupBy(*PLACE).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(first.bitwiseAND(HALF)).alias("a"),
        F.sum(F.shiftright(first, 32)).alias("b"),
        F.sum(second.bitwiseAND(HALF)).alias("c"),
        F.sum(F.shiftright(second, 32)).alias("d"),
    )


def differing(source: DataFrame, target: DataFrame) -> DataFrame:
    """The (day, bucket)s whose digests differ, one side's absence included."""
    figures = ["n", "a", "b", "c", "d"]
    both = source.unionByName(target.select(*PLACE, *((-F.col(c)).alias(c) for c in figures)))
    off = both.groupBy(*PLACE).agg(*(F.sum(c).alias(c) for c in figures))
    return off.filter(" OR ".join(f"{c} <> 0" for c in figures)).select(*PLACE)


def _in_places(placed: DataFrame, places: DataFrame, how: str) -> DataFrame:
    there = places.toDF("__day", "__bucket")
    return placed.join(there, placed["day"].eqNullSafe(there["__day"]) & (placed["bucket"] == there["__bucket"]), how)


def compare_days(
    source: DataFrame, target: DataFrame, keys: list[str], day: str, target_day: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Every distinct key of either side with its `provenance`, as `compare_keys` has it.

    `day` (`target_day`) is the column whose days part the tables.  Both sides are reduced
    to a digest per day and bucket of keys.  Where these agree the target's keys are
    the source's, and are not looked at again; elsewhere they are compared.  Lakes and sources
    mostly agree, so what is shuffled is the source's keys and few of the target's.
    A key that has moved to another day differs in both, and is found in both.

    Two sets that differ agree in count and both sums by chance once in about 2^128.
    Keys must have one type on both sides: what compares equal must hash equal.
    """
    for k in keys:
        if source.schema[k].dataType != target.schema[k].dataType:
            raise ValueError(f"{k} is {source.schema[k].dataType.simpleString()} in the source and {target.schema[k].dataType.simpleString()} in the target")
    left = _placed(source, keys, calendar_day(source, day), buckets)
    right = _placed(target, keys, calendar_day(target, target_day or day), buckets)
    places = stage(differing(key_digests(left, keys), key_digests(right, keys)), "places")
    same = _in_places(left, places, "left_anti").select(*keys, F.lit(True).alias("__s"), F.lit(True).alias("__t"))
    mine = _in_places(left, places, "left_semi").select(*keys, F.lit(True).alias("__s"), F.lit(False).alias("__t"))
    theirs = _in_places(right, places, "left_semi").select(*keys, F.lit(False).alias("__s"), F.lit(True).alias("__t"))
    found = same.unionByName(mine).unionByName(theirs).groupBy(*keys).agg(F.max("__s").alias("__s"), F.max("__t").alias("__t"))
    provenance = F.when(F.col("__s") & F.col("__t"), BOTH).when(F.col("__s"), SOURCE_ONLY).otherwise(TARGET_ONLY)
    return found.select(*keys, provenance.alias("provenance"))


def differences(
    source: DataFrame, target: DataFrame, keys: list[str], day: str, target_day: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Only the keys that one side lacks, with their `provenance`; keys of places that agree are never shuffled.

    The scans for keys are bounded by the first and last day that differ, which reaches
    the files.  A key that seems to be missing may stand among another day's keys that agree;
    the few candidates are looked up there before they are returned.
    """
    left = _placed(source, keys, calendar_day(source, day), buckets)
    right = _placed(target, keys, calendar_day(target, target_day or day), buckets)
    places = stage(differing(key_digests(left, keys), key_digests(right, keys)), "places")
    low, high, without = places.agg(F.min("day"), F.max("day"), F.count(F.when(F.col("day").isNull(), 1))).first()
    inside = F.col("day").between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
    inside = inside | F.col("day").isNull() if without else inside
    mine = _in_places(left.filter(inside), places, "left_semi").select(*keys, F.lit(True).alias("__s"), F.lit(False).alias("__t"))
    theirs = _in_places(right.filter(inside), places, "left_semi").select(*keys, F.lit(False).alias("__s"), F.lit(True).alias("__t"))
    found = mine.unionByName(theirs).groupBy(*keys).agg(F.max("__s").alias("__s"), F.max("__t").alias("__t"))
    odd = stage(found.filter("__s <> __t"), "odd-keys")
    # What agrees is in both sides; the source's copy of it tells.
    names = [f"__{k}" for k in keys]
    wanted = odd.select(*keys).toDF(*names)
    match = F.lit(True)
    for k, n in zip(keys, names):
        match = match & left[k].eqNullSafe(F.col(n))
    settled = _in_places(left.join(wanted, match, "left_semi"), places, "left_anti").select(*keys).distinct().toDF(*names)
    left_over = F.lit(True)
    for k, n in zip(keys, names):
        left_over = left_over & odd[k].eqNullSafe(settled[n])
    return odd.join(settled, left_over, "left_anti").select(*keys, F.when(F.col("__s"), SOURCE_ONLY).otherwise(TARGET_ONLY).alias("provenance"))
