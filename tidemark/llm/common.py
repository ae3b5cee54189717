"""Helpers the operators share: staged tables, distributed numbering, binary files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.staging import new_path

WHITE = "[\\x20\\x09-\\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: lineage ends here, sizes are known."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """What is written meanwhile goes to Python in batches of at most `rows` rows, so that tasks hold few whole texts at a time."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def keeping_columns(*core: str) -> Callable:
    """Decorates an operator from rows to rows: it sees the columns of `core` and one more that holds all others.

    Columns of any other name thus reach its result untouched, whatever it calls its own.
    """

    def decorate(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(operator)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            seen = [c for c in docs.columns if c in core]
            others = [c for c in docs.columns if c not in core]
            quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in docs.columns}
            held = docs.select(*seen, F.struct(*(quoted[c].alias(str(i)) for i, c in enumerate(others))).alias("_others")) if others else docs
            back = {c: F.col("_others")[str(i)].alias(c) for i, c in enumerate(others)}
            return operator(held, *args, **options).select(*(back.get(c, F.col(c)) for c in docs.columns))

        return run

    return decorate


def staying(rows: DataFrame, told: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key that `told` (keys, kept) keeps.

    Only what goes is looked up: wide rows are read past the keys that are dropped, which
    Catalyst broadcasts where they are few, and only keys that several kept rows have are
    brought together.  Null keys are keys like others.
    """
    told = staged(told.select(*keys, "kept"), "told")
    names = [f"_key_{i}" for i in range(len(keys))]
    again = told.filter("kept").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys).toDF(*names)
    again = staged(again, "repeated")
    gone = staged(told.filter("NOT kept").select(*keys).distinct().toDF(*names).unionByName(again), "dropped")
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    rest = rows.join(gone, same, "left_anti")
    if again.isEmpty():
        return rest
    return rest.unionByName(rows.join(again, same, "left_semi").dropDuplicates(keys))


def own_key(column: str) -> Column:
    """A never-null key for a nullable text column: null and every text differ."""
    return F.coalesce(F.concat(F.lit("v"), F.col(column)), F.lit("n"))


def numbered(rows: DataFrame, keys: list[str], order: list[str], buckets: int = 1024, sums: Iterable[str] = ()) -> DataFrame:
    """Add `rank` (from 0 within `keys`) and, per column c of `sums`, `c_before` (the sum over smaller ranks).

    Ranks follow (hash bucket of `order`, `order`).  The rows of one key are spread
    over `buckets` window partitions, whose counts give each its first rank, so that
    a key with a third of all rows is not numbered by one task.  `order` must tell
    the rows of a key apart, else tied rows share their ranks in any order.
    """
    spread = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    at = [*keys, "_bucket"]
    counts = spread.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"), *(F.sum(c).alias(f"_sum_{c}") for c in sums))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        *at,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
        *(F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_base_{c}") for c in sums),
    )
    within = Window.partitionBy(*at).orderBy(*order)
    return (
        spread.join(base, at)
        .withColumn("rank", F.col("_base") + F.row_number().over(within) - 1)
        .withColumns({f"{c}_before": F.col(f"_base_{c}") + F.sum(c).over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col(c) for c in sums})
        .drop("_bucket", "_base", *(f"_base_{c}" for c in sums))
    )


def write_files(blobs: DataFrame, path: str, end: str, compression: str = "none") -> None:
    """Write each row's binary `blob` as a file of its own, followed by `end`.

    Spark's own committed writer does it, so the files may lie in any store that
    Spark reaches and a task that is run again leaves one copy.
    """
    text = blobs.select(F.col("blob").cast("string").alias("value"))
    text.write.option("maxRecordsPerFile", 1).option("lineSep", end).option("compression", compression).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder as rows of `content` (binary)."""
    return spark.read.format("binaryFile").load(path).select("content")
