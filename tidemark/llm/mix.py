"""Mixing sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, own_key, staged

WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(column: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(column).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


# Texts of more words are taken greedily; the table of reachable totals is over shorter ones, so its size is bounded.
LONG = 1 << 20


def subset(lengths: np.ndarray, counts: np.ndarray, budget: int, long: int = LONG) -> np.ndarray:
    """How many of each length to take so that the total comes as near `budget` as its bounds allow.

    Every length first gives its share, rounded down.  Large pieces bring the rest
    under four times the longest length up to `long`, and a bounded-knapsack table over that rest
    finds the reachable total nearest to it; counts are split in powers of two.  Lengths beyond
    `long` are only taken while they fit, longest first, and if nothing shorter is left, once more where that comes nearer.
    """
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = (counts * (budget / total)).astype(np.int64)
    rest = budget - int((lengths * taken).sum())
    order = np.argsort(-lengths, kind="stable")
    short = lengths <= long
    keep = 4 * int(lengths[short].max(initial=0))
    for i in order:
        if rest <= keep:
            break
        left, length = int(counts[i] - taken[i]), int(lengths[i])
        more = min(left, (rest - keep) // length + 1 if short[i] else rest // length)
        taken[i] += more
        rest -= more * length
    if rest > keep:
        # Only lengths that do not fit are left.
        over = [i for i in order if taken[i] < counts[i] and abs(rest - int(lengths[i])) < rest]
        if over:
            taken[min(over, key=lambda i: abs(rest - int(lengths[i])))] += 1
        return taken
    if rest == 0:
        return taken
    # The table reaches past the rest by the shortest piece, so that the nearest total may lie on either side.
    reach = rest + int(lengths.min())
    via = np.full(reach + 1, -1, dtype=np.int32)
    got = np.zeros(reach + 1, dtype=bool)
    got[0] = True
    pieces = []
    for i in order[::-1]:
        left, power = min(int(counts[i] - taken[i]), reach // int(lengths[i])), 1
        while left > 0 and not got[rest]:
            n = min(power, left)
            weight = n * int(lengths[i])
            new = np.zeros_like(got)
            new[weight:] = got[: reach + 1 - weight]
            new &= ~got
            via[new] = len(pieces)
            got |= new
            pieces.append((i, n, weight))
            left -= n
            power *= 2
        if got[rest]:
            break
    sums = np.flatnonzero(got)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    while at > 0:
        i, n, weight = pieces[via[at]]
        taken[i] += n
        at -= weight
    return taken


def targets(totals: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """One row per source (`_source`, source_size) with its `target`.

    Sources in code-point order, null last, take `weights` in turn.  Raising all
    uncapped targets together until the budget is spent is what passing excess on
    leads to: with sources in order of the level at which they reach their cap, the
    first ones are capped, and the level of the rest follows from two running sums.
    The windows see one row per source.  A source without words has target 0.
    """
    turn = F.pmod(F.row_number().over(Window.orderBy(F.desc(F.substring("_source", 1, 1)), "_source")) - 1, F.lit(len(weights)))
    weighed = totals.withColumn("_weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int")))
    full = weighed.filter("source_size > 0").withColumn("_cap", F.col("source_size") * F.lit(float(most))).transform(_level, share)
    empty = weighed.filter("source_size = 0").select("_source", "source_size", F.lit(0.0).alias("target"))
    return full.unionByName(empty)


def _level(weighed: DataFrame, share: float) -> DataFrame:
    by_level = Window.orderBy(F.col("_cap") / F.col("_weight"), "_source")
    whole = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(whole) * F.lit(float(share))
    level = (budget - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
    # The first source that its level does not fill sets the level of all after it.
    ranked = weighed.withColumn("_level", level)
    free = F.min(F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_weight"), "_source", "_level"))).over(whole)
    return ranked.withColumn("_free", free["_level"]).select(
        "_source", "source_size", F.least(F.col("_cap"), F.coalesce(F.col("_weight") * F.col("_free"), F.col("_cap"))).alias("target")
    )


def mixture(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, whole, extra, taken.

    A source's target holds `whole` copies of all its documents; the rest of its
    budget is fitted by taking one more copy of as many documents of each length as
    `subset` says, the first by a seeded hash.  Only the histogram of lengths of a
    source meets in one task.  Ranks within a length come from `numbered`, so that
    one length may hold any share of the rows.  Reruns take the same documents; rows
    that repeat a doc_id of one length are told apart by their text's hash, and
    identical rows are interchangeable.  A null text has size 0; documents of size 0
    are never taken; the order of nullable sources puts null last.
    """
    order = ["_seeded", "doc_id", "_tie"]
    rows = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count("text").alias("size"),
            F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("_seeded"),
            F.xxhash64(F.col("text").cast("string")).alias("_tie"),
        ).withColumn("_source", own_key("source")),
        "mix",
    )
    histogram = staged(rows.groupBy("_source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-lengths")
    totals = histogram.groupBy("_source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    aimed = targets(totals, weights, share, most).withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        lengths, counts = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
        budget = int(round(float(group["target"].iloc[0]) - int(group["_whole"].iloc[0]) * int(group["source_size"].iloc[0])))
        return group[["_source", "size"]].assign(_extra=subset(lengths, counts, budget) if budget > 0 else 0)

    quotas = (
        histogram.filter("size > 0").join(aimed, "_source").groupBy("_source").applyInPandas(fit, "_source string, size long, _extra long")
    )
    plan = staged(histogram.join(aimed, "_source").join(quotas, ["_source", "size"], "left"), "mix-plan").select(
        "_source", "size", "source_size", "target", "_whole", F.coalesce("_extra", F.lit(0)).alias("_extra")
    )
    ranked = numbered(rows, ["_source", "size"], order)
    whole, extra = F.col("_whole"), (F.col("rank") < F.col("_extra")).cast("long")
    return ranked.join(plan, ["_source", "size"]).select(
        "doc_id", "source", "size", "source_size", "target", whole.alias("whole"), extra.alias("extra"), (F.col("size") * (whole + extra)).alias("taken"), "_tie"
    )

