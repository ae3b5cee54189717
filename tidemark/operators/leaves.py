"""Known leaf paths of a table's records: found once, kept, and extended by the records that differ."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.flatten import Leaf, as_leaves, as_variant, find_leaves, flatten
from tidemark.plans.staging import stage
from tidemark.sinks import records
from tidemark.sources.landed import value_at


def known_leaves(spark: SparkSession, registry: str) -> list[Leaf] | None:
    """The leaf paths kept in a folder; None before the first run."""
    _, record = records.latest(spark, registry)
    if record is None:
        return None
    return [Leaf(**{**leaf, "segments": tuple(leaf["segments"])}) for leaf in record["leaves"]]


def joined(known: list[Leaf], more: list[Leaf]) -> list[Leaf]:
    """The leaves of both, with what was seen at each place by either."""
    kinds: dict[tuple, set[str]] = defaultdict(set)
    for leaf in [*known, *more]:
        kinds[leaf.embedded is not None, leaf.segments].add("empty" if leaf.empty else "value")
    return as_leaves(kinds)


# What a scalar is does not matter for the paths.
SCALAR = r"(: |ARRAY<)(DECIMAL\(\d+,\d+\)|BIGINT|DOUBLE|FLOAT|STRING|BOOLEAN|VOID|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|UUID|VARIANT)(?=[,>])"


def _shape(value: Column) -> Column:
    """Keys and containers of a value, array elements merged, as a hash; null where there is none."""
    return F.when(value.isNotNull(), F.xxhash64(F.regexp_replace(F.schema_of_variant(value), SCALAR, "$1S")))


def _nodes(leaves: list[Leaf]) -> list[tuple]:
    """The record and every array element seen: merged shapes say nothing of single elements, so each has one of its own."""
    found = {leaf.segments[: n + 1] for leaf in leaves for n, segment in enumerate(leaf.segments) if isinstance(segment, int)}
    return [(), *sorted(found, key=repr)]


def _beyond(record: Column, leaves: list[Leaf]) -> Column:
    """Whether an array goes on after the last element that was ever seen of it."""
    last: dict[tuple, int] = {leaf.segments: -1 for leaf in leaves if leaf.empty}
    for leaf in leaves:
        for n, segment in enumerate(leaf.segments):
            if isinstance(segment, int):
                last[leaf.segments[:n]] = max(segment, last.get(leaf.segments[:n], -1))
    found = F.lit(False)
    for prefix, n in sorted(last.items(), key=repr):
        found = found | value_at(record, [*prefix, n + 1], "variant").isNotNull()
    return found


def _new(record: Column, leaves: list[Leaf], shapes: dict[str, list[int]]) -> Column:
    """Whether a record may hold a path that is not among the leaves."""
    found = _beyond(record, leaves)
    for node in _nodes(leaves):
        known = shapes.get(repr(list(node)), [])
        shape = _shape(value_at(record, node, "variant"))
        found = found | (shape.isNotNull() & ~shape.isin(*known) if known else shape.isNotNull())
    return found


def _learn(rows: DataFrame, column: str, registry: str, leaves: list[Leaf], shapes: dict[str, list[int]], number: int) -> list[Leaf]:
    """Add the paths and shapes of some rows to the registry; its size is that of the schema."""
    spark = rows.sparkSession
    leaves = joined(leaves, find_leaves(rows, column))
    nodes = _nodes(leaves)
    pairs = F.array(*(F.struct(F.lit(i).alias("node"), _shape(value_at(F.col(column), node, "variant")).alias("shape")) for i, node in enumerate(nodes)))
    seen = rows.select(F.inline(pairs)).filter("shape IS NOT NULL").distinct().collect()
    shapes = {k: list(v) for k, v in shapes.items()}
    for r in seen:
        shapes.setdefault(repr(list(nodes[r["node"]])), []).append(r["shape"])
    record = {"leaves": [vars(leaf) for leaf in leaves], "shapes": {k: sorted(set(v)) for k, v in shapes.items()}}
    if not records.put(spark, registry, number + 1, record):
        # Another run has learnt as well: add to what it knows.
        number, other = records.latest(spark, registry)
        return _learn(rows, column, registry, joined(known_leaves(spark, registry), leaves), other["shapes"], number)
    return leaves


def flatten_known(df: DataFrame, column: str, registry: str, *, empty_as: str | None = None, only: str | None = None) -> DataFrame:
    """`flatten` with the paths of earlier runs; the result is staged.

    The pass that flattens and writes the rows also tells which of them may hold
    paths nobody has seen: rows where the record or an array element has a new shape (a new
    set of keys and containers, by 64-bit hash), or an array is longer than any before.  Only those
    are searched for paths, and flattened again; the registry learns from them.  The first
    run, without a registry, searches all rows.  Columns that the registry knows and
    no row has are null.

    `only` names a boolean column: other rows carry no record and are passed on.
    `column` is VARIANT, or JSON text that is parsed once; embedded text stays text.
    """
    spark = df.sparkSession
    if not isinstance(df.schema[column].dataType, T.VariantType):
        df = df.withColumn(column, as_variant(F.col(column)))
    number, record = records.latest(spark, registry)
    wanted = F.col(only) if only else F.col(column).isNotNull()
    if record is None:
        rows = stage(df, "records")
        return stage(flatten(rows, column, _learn(rows.filter(wanted), column, registry, [], {}, number), empty_as=empty_as), "flat")
    leaves = known_leaves(spark, registry)
    odd = F.coalesce(wanted & _new(F.col(column), leaves, record["shapes"]), F.lit(False))
    told = df.withColumn("__odd", odd).withColumn("__record", F.when(F.col("__odd"), F.col(column)))
    done = stage(flatten(told, column, leaves, empty_as=empty_as), "flat")
    drifted = done.filter("__odd")
    if drifted.isEmpty():
        return done.drop("__odd", "__record")
    more = _learn(drifted.select("__record"), "__record", registry, leaves, record["shapes"], number)
    again = flatten(drifted.drop("__odd", *{leaf.name for leaf in leaves}), "__record", more, empty_as=empty_as)
    return stage(done.filter("NOT __odd").drop("__odd", "__record").unionByName(again, allowMissingColumns=True), "flat")
