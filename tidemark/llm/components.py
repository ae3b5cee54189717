"""Connected components by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


# Edges that a task turns into stars at a time, and that one task may finish.
EDGES = 100_000


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node of it) for the nodes of `links` (a, b), which have one orderable type.

    Large-star hangs each node's larger neighbours on its smallest one, small-star its
    smaller ones; they alternate until only stars are left, in about the
    logarithm of the longest path's rounds.  Before each round, tasks of some `EDGES`
    edges turn theirs into stars, which shortens paths without a shuffle; so few
    edges that one such task reads them all are then done.  Edges stay in staged tables.
    """
    a, b = F.col("a"), F.col("b")
    edges, done = _shortened(staged(links.filter(a != b).select("a", "b"), "links"))
    while not done:
        both = edges.union(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("_least"))
        large = both.join(least, "a").filter(b > a).select(b.alias("a"), F.col("_least").alias("b")).filter(a != b)
        large = staged(large.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("_least"))
        small = large.join(least, "a").select(b.alias("a"), F.col("_least").alias("b")).union(least.select("a", F.col("_least").alias("b")))
        edges, done = _shortened(staged(small.filter(a != b).distinct(), "links"))
    nodes = edges.select(a.alias("node"), b.alias("component"))
    return nodes.union(edges.select(b, b).distinct())


def _shortened(edges: DataFrame) -> tuple[DataFrame, bool]:
    """The staged `edges` as stars within tasks, and whether only stars are left."""
    tasks = max(1, -(-edges.count() // EDGES))
    kind = edges.schema["a"].dataType.simpleString()
    local = edges.coalesce(tasks).mapInArrow(_contracted, f"a {kind}, b {kind}")
    local = staged(local if tasks == 1 else local.distinct(), "links")
    return local, tasks == 1 or _stars(local)


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one task as stars, each node on the smallest one, some `EDGES` at a time."""
    top: dict = {}

    def root(x):
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    def flush() -> pa.RecordBatch:
        hung = [(x, root(x)) for x in top]
        hung = [(x, y) for x, y in hung if x != y]
        top.clear()
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in hung], kind), pa.array([y for _, y in hung], kind)], ["a", "b"])

    kind, seen = None, 0
    for batch in batches:
        kind = batch.schema.field("a").type
        for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            top.setdefault(x, x)
            top.setdefault(y, y)
            x, y = root(x), root(y)
            if x != y:
                low, high = (x, y) if x < y else (y, x)
                top[high] = low
        seen += batch.num_rows
        if seen >= EDGES:
            yield flush()
            seen = 0
    if top:
        yield flush()


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, on which nothing but such nodes hang: nothing is left to be moved."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.union(edges.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    known = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return known.filter("hangs > 1 OR (hangs = 1 AND holds = 1)").isEmpty()
