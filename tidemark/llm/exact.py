"""Exact duplicates: local, salted, then global combining, each over full contents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WHITE, keeping_columns, staying


def normalised(docs: DataFrame) -> DataFrame:
    """Add `_norm`: the text with each run of ASCII white space as one space, null as empty."""
    return docs.withColumn("_norm", F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), WHITE, " "))


def exact_groups(docs: DataFrame, salts: int = 16) -> DataFrame:
    """Per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are combined three times by (digest, full text): on the map side of the
    first grouping, per salt (the task that read the row) by its reduce side, and
    over the salts by the second grouping.  A group of copies with a third of all
    rows thus reaches any task as one row per map task, then one per salt.  The rows
    find their group again by digest, a second hash and the length; that join is a
    plain one, which adaptive execution splits where a digest is hot.

    Null and empty texts are equal.  Rows that repeat a doc_id count each; all rows
    with the smallest doc_id of the group are `kept`.  A null doc_id loses against
    any other; keep_id is null where all are, and such rows are kept.  Other columns
    of `docs` are ignored; an empty table gives an empty result.
    """
    rows = normalised(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(F.encode("_norm", "UTF-8"), 256).alias("text_sha256"),
        "_norm",
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"),
    )
    salted = rows.groupBy("text_sha256", "_norm", "_salt").agg(F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("_n"))
    groups = salted.groupBy("text_sha256", "_norm").agg(F.min("_least").alias("keep_id"), F.sum("_n").alias("group_size"))
    check = [F.xxhash64("_norm").alias("_hash"), F.length("_norm").alias("_length")]
    found = groups.select("text_sha256", *check, "keep_id", "group_size")
    members = rows.select("doc_id", "text_sha256", *check)
    return members.join(found, ["text_sha256", "_hash", "_length"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


@keeping_columns("doc_id", "text")
def without_copies(docs: DataFrame, salts: int = 16) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; of rows that repeat a doc_id and text, one stays.

    Null and empty texts are equal; a null doc_id stays only where all of its group are
    null; an empty table stays empty.
    """
    told = exact_groups(docs, salts).select("doc_id", F.col("text_sha256").alias("_digest"), "kept")
    rows = normalised(docs).withColumn("_digest", F.sha2(F.encode("_norm", "UTF-8"), 256)).drop("_norm")
    return staying(rows.withColumn("doc_id", F.col("doc_id").cast("long")), told, ["doc_id", "_digest"]).drop("_digest")
