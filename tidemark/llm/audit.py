"""Interaction of filters: what each removes, after any others, by relations of failing ids."""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WHITE, staged

ROW = "_row"


def text_rules(text: str = "text") -> dict[str, Column]:
    """The rules on one text, true where it fails: too short, repetitive, capitals, symbols."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.array_remove(F.split(body, WHITE), "")
    capitals = F.length(body) - F.length(F.translate(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * 50,
        "C": capitals.cast("long") * 100 > F.length(body).cast("long") * 2,
        "D": body.rlike(r"[#$%&*|]"),
    }


def failing(docs: DataFrame, rules: dict[str, Column], repeat: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(every row of `docs` with its number, doc_id and part; per rule its table of failing rows).

    Rows are numbered when they are first written, so that rows that repeat a doc_id
    stay apart.  `repeat` names the rule that a row fails when a smaller doc_id has its
    text.  Texts meet by SHA-256 and length, which are combined before the shuffle; rows
    find the least doc_id of their text by a plain join with the texts that occur
    twice, which adaptive execution splits where a text is hot.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    text = [F.unhex(F.sha2(F.encode(body, "UTF-8"), 256)).alias("_digest"), F.length(body).alias("_length")]
    rows = docs.select(
        F.monotonically_increasing_id().alias(ROW),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        *text,
        *(rule.alias(f"_{name}") for name, rule in rules.items()),
    )
    rows = staged(rows, "marked")
    tables = {name: rows.filter(f"_{name}").select(ROW, "part") for name in rules}
    first = rows.groupBy("_digest", "_length").agg(F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("_n"))
    again = rows.join(first.filter("_n > 1"), ["_digest", "_length"]).filter("doc_id > _least").select(ROW, "part")
    tables[repeat] = again
    return rows.select(ROW, "doc_id", "part"), {name: staged(table, f"fails-{name}") for name, table in tables.items()}


def filter_audit(rows: DataFrame, tables: dict[str, DataFrame], losses: dict[str, DataFrame]) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, one count per loss, shapley.

    `rows` has a number (`_row`), doc_id and part of every document; `tables` has per
    filter, named by a letter, the rows that fail it; `losses` has per column the
    doc_ids whose removal is a loss (a document counts once, however often it is listed).

    What a step does depends on the set of filters before it, not on their order.  The
    survivors of a set are those of the set without its last filter, left-anti joined with
    that filter's table; what a filter removes after a set is its left-semi join with
    the survivors; what it finds gone already is the left-anti join of its table with
    what it removed; losses are left-semi joins of the removed rows.  One round of
    joins takes all sets of one size, keyed by (filter, row), which spreads any hot part,
    and only rows that fail some filter are joined.  Counts are combined before they are
    shuffled.  The orders are then looked up: 120 for five filters.

    Numbers of `rows` must be unique.  Null doc_ids are in no loss.  A part without failing
    rows gives zeros; an empty table gives an empty result.
    """
    names = sorted(tables)
    bits = {name: 1 << i for i, name in enumerate(names)}
    every = (1 << len(names)) - 1
    fails = reduce(DataFrame.unionByName, (tables[n].select(F.lit(bits[n]).alias("step"), ROW, "part") for n in names))
    each = F.array(*(F.lit(b) for b in bits.values()))
    failed = fails.select("step", ROW)

    level = staged(fails.select(F.lit(0).alias("done"), ROW, "part").distinct(), "survivors")
    left, removed = [level], []
    for size in range(len(names)):
        after = level.withColumn("step", F.explode(F.filter(each, lambda b: F.col("done").bitwiseAND(b) == 0)))
        removed.append(staged(after.join(failed, ["step", ROW], "left_semi").select("done", "step", ROW, "part"), "removed"))
        if size + 1 < len(names):
            longer = level.withColumn("step", F.explode(F.filter(each, lambda b: b > F.col("done"))))
            stays = longer.join(failed, ["step", ROW], "left_anti")
            level = staged(stays.select(F.col("done").bitwiseOR(F.col("step")).alias("done"), ROW, "part"), "survivors")
            left.append(level)
    gone = reduce(DataFrame.unionByName, removed)
    at = ["part", "done", "step"]

    def counts(table: DataFrame, column: str) -> DataFrame:
        return table.groupBy(*at).agg(F.count(F.lit(1)).alias(column))

    before = fails.withColumn("done", F.explode(F.sequence(F.lit(0), F.lit(every)))).filter(F.col("done").bitwiseAND(F.col("step")) == 0)
    figures = [counts(gone, "removed"), counts(before.join(gone, ["done", "step", ROW], "left_anti"), "redundant")]
    for column, ids in losses.items():
        lost = rows.join(ids.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi").select(ROW)
        figures.append(counts(gone.join(lost, ROW, "left_semi"), column))

    totals = rows.groupBy("part").agg(F.count(F.lit(1)).alias("_total"))
    kept = reduce(DataFrame.unionByName, left).groupBy("part", "done").agg(F.count(F.lit(1)).alias("_left"))
    clean = totals.join(kept.filter("done = 0").select("part", F.col("_left").alias("_failing")), "part", "left")
    clean = clean.select("part", (F.col("_total") - F.coalesce("_failing", F.lit(0))).alias("_clean"))
    grid = clean.withColumn("done", F.explode(F.sequence(F.lit(0), F.lit(every)))).withColumn("step", F.explode(F.filter(each, lambda b: F.col("done").bitwiseAND(b) == 0)))
    for figure in figures:
        grid = grid.join(figure, at, "left")
    grid = grid.withColumn("_after", F.col("done").bitwiseOR(F.col("step")))
    grid = grid.join(kept.select("part", F.col("done").alias("_after"), "_left"), ["part", "_after"], "left")
    columns = ["removed", "redundant", *losses]
    grid = grid.select(*at, (F.col("_clean") + F.coalesce("_left", F.lit(0))).alias("kept"), *(F.coalesce(c, F.lit(0)).alias(c) for c in columns))
    # So many orders have just these filters before this one.
    size = F.bit_count("done").cast("int")
    ways = F.element_at(F.array(*(F.lit(factorial(k) * factorial(len(names) - 1 - k)).cast("long") for k in range(len(names)))), size + 1)
    own = Window.partitionBy("part", "step")
    grid = grid.withColumn("shapley", F.sum(F.col("removed") * ways).over(own))
    alone = F.col("done").bitwiseOR(F.col("step")) == every
    grid = grid.withColumn("unique_fails", F.max(F.when(alone, F.col("removed"))).over(own))

    orders = [("".join(order), k + 1, sum(bits[n] for n in order[:k]), bits[order[k]]) for order in permutations(names) for k in range(len(names))]
    orders = rows.sparkSession.createDataFrame(orders, "filter_order string, number int, done int, step int")
    return grid.join(F.broadcast(orders), ["done", "step"]).select(
        "part", "filter_order", F.col("number").alias("step"), "kept", "removed", "redundant", "unique_fails", *losses, "shapley"
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of rules A to E over `docs` (doc_id, text, source) with `labels` (doc_id, quality, toxic).

    Null texts are empty, a null source is the empty part.  A null doc_id is smaller
    than none: such a row never fails E nor makes another fail it.  Rows that repeat a
    doc_id count each, and so do their repeats in the counts of losses.  Other columns are
    ignored; empty labels give no losses.
    """
    rows, tables = failing(docs, text_rules(), "E")
    return filter_audit(rows, tables, {"good_lost": labels.filter("quality = 1"), "toxic_lost": labels.filter("toxic = 1")})
