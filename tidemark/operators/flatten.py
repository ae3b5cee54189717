"""Flattening nested JSON records to wide tables.

Keys are joined with a separator, list elements use their index, and whatever is
empty, zero, false or null is a leaf kept as it is.

The width of the result depends on the data, so flattening is two steps:

1. `find_leaves` lists the distinct leaf paths.  It explodes records level by level
   in one pass; only distinct paths are shuffled, after map-side combining.
2. `flatten` reads each path out of the record.  It is a projection: no shuffle,
   no grouping, whatever the number of records.

A job that knows its paths (from the previous run or a catalog) skips step 1.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import clean_text
from tidemark.sources.landed import step, value_at

EMPTY_OBJECT, EMPTY_ARRAY = "{}", "[]"


@dataclass(frozen=True)
class Leaf:
    """One place a leaf was seen.

    `path` addresses it inside its record; `embedded` is the path of the top-level
    text that had to be parsed to get there.  `empty` says an empty container was
    seen here, `nested` that other records hold more levels below it.
    """

    name: str
    path: str
    segments: tuple[str | int, ...]
    embedded: str | None = None
    empty: bool = False
    nested: bool = False


def as_variant(column: Column, strict: bool = True) -> Column:
    """JSON text as VARIANT; unreadable text is an error, or null when not strict."""
    return F.parse_json(column) if strict else F.try_parse_json(column)


def _path(segments: Iterable[str | int]) -> str:
    """A path as text; keys that no path can spell are written as they are, to tell places apart."""
    return "$" + "".join(step(segment) or f"[{segment}]" for segment in segments)


def _get(document: Column, leaf: Leaf, kind: str) -> Column:
    """The leaf inside its document, which is the embedded one where there is one."""
    return value_at(document, leaf.segments[1:] if leaf.embedded else leaf.segments, kind)


def _is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def _embedded_object(value: Column, clean: bool) -> Column:
    """The object written as text inside `value`, else null."""
    text = F.when(_is_text(value), F.try_variant_get(value, "$", "string"))
    parsed = F.try_parse_json(clean_text(text) if clean else text)
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed)


def _expand(df: DataFrame, first: bool) -> DataFrame:
    """One level down.  Leaves have nothing to explode and stay as they are."""
    spark = df.sparkSession
    explode = spark.tvf.variant_explode if first else spark.tvf.variant_explode_outer
    down = df.lateralJoin(explode(F.col("value").outer()).toDF("pos", "key", "child"))
    moved = F.col("pos").isNotNull()
    longer = F.concat(F.col("segments"), F.array(F.struct("key", "pos")))
    return down.select(
        F.when(moved, longer).otherwise(F.col("segments")).alias("segments"),
        F.when(moved, F.col("child")).otherwise(F.col("value")).alias("value"),
        F.col("embedded"),
    )


def _leaf_rows(records: DataFrame, depth: int, embedded: bool, clean: bool, ignore: Iterable[str]) -> DataFrame:
    """Distinct (segments, embedded, kind); `embedded` says the first segment was text."""
    level = records.select(
        F.array().cast("array<struct<key:string,pos:int>>").alias("segments"), F.col("value"), F.lit(False).alias("embedded")
    )
    level = _expand(level, first=True)
    if ignore:
        level = level.filter(~F.col("segments")[0]["key"].isin(*ignore))
    if embedded:
        level = level.withColumn("inner", _embedded_object(F.col("value"), clean)).select(
            F.col("segments"), F.coalesce("inner", "value").alias("value"), F.col("inner").isNotNull().alias("embedded")
        )
    for _ in range(depth - 1):
        level = _expand(level, first=False)
    shape = level.select("segments", "embedded", "value", F.schema_of_variant("value").alias("shape"))
    container = F.col("shape").startswith("OBJECT<") | F.col("shape").startswith("ARRAY<")
    empty = (F.col("shape") == "OBJECT<>") | (F.to_json("value") == EMPTY_ARRAY)
    kind = F.when(~container, "value").when(empty, "empty").otherwise("deeper")
    return shape.select("segments", "embedded", kind.alias("kind")).distinct()


def find_leaves(
    df: DataFrame,
    column: str,
    *,
    embedded: bool = False,
    clean: bool = False,
    separator: str = "_",
    ignore_root_keys: Iterable[str] = (),
    replace_separators: str | None = None,
    strict: bool = True,
    depth: int = 4,
    max_columns: int | None = None,
) -> list[Leaf]:
    """The distinct leaf paths of all records in `column`, sorted by name.

    `depth` is the first guess at the nesting; a pass that meets deeper records is
    repeated with twice the depth.  More than `max_columns` paths, if it is given, is
    an error rather than a partial result.
    """
    is_variant = isinstance(df.schema[column].dataType, T.VariantType)
    value = F.col(column) if is_variant else as_variant(F.col(column), strict)
    records = df.select(value.alias("value"))
    while True:
        found = _leaf_rows(records, depth, embedded, clean, tuple(ignore_root_keys)).transform(lambda d: d if max_columns is None else d.limit(2 * max_columns + 1)).collect()
        if not any(row.kind == "deeper" for row in found):
            break
        depth *= 2
    kinds: dict[tuple, set[str]] = defaultdict(set)
    for row in found:
        segments = tuple(s.key if s.key is not None else s.pos for s in row.segments)
        kinds[(row.embedded, segments)].add(row.kind)
    if max_columns is not None and len(kinds) > max_columns:
        raise ValueError(f"more than {max_columns} distinct paths in {column}; raise max_columns")

    return as_leaves(kinds, separator, replace_separators)


def as_leaves(kinds: dict[tuple, set[str]], separator: str = "_", replace_separators: str | None = None) -> list[Leaf]:
    """The leaves of places, (embedded, segments), and the kinds of value seen there; sorted by name."""

    def name(segments: tuple) -> str:
        parts = [str(s) for s in segments]
        if replace_separators is not None:
            parts = [p.replace(separator, replace_separators) for p in parts]
        return separator.join(parts)

    # A path is nested when another path of the same document continues it.
    prefixes = {(e, s[:n]) for e, s in kinds for n in range(len(s))}
    leaves = [
        Leaf(
            name(s),
            _path(s[1:]) if e else _path(s),
            s,
            _path(s[:1]) if e else None,
            "empty" in kind,
            (e, s) in prefixes,
        )
        for (e, s), kind in kinds.items()
    ]
    return sorted(leaves, key=lambda leaf: (leaf.name, leaf.embedded or "", leaf.path))


def _leaf_value(document: Column, leaf: Leaf, clean: bool, empty_as: str | None) -> Column:
    value = _get(document, leaf, "string")
    if not (leaf.empty or leaf.nested):
        return clean_text(value) if clean else value
    # Only text that looks like a container needs to be told from one.
    blank = value if empty_as is None else F.lit(empty_as)
    shape = F.schema_of_variant(_get(document, leaf, "variant"))
    text = clean_text(value) if clean else value
    return (
        F.when(~value.rlike(r"^[\[{]"), text)
        .when(shape == "STRING", text)
        .when(value.isin(EMPTY_OBJECT, EMPTY_ARRAY), blank)
    )


def _position(text: Column, leaf: Leaf) -> Column:
    """Where the leaf stands in its JSON text: the position of each key among its siblings."""
    steps, path = [], "$"
    for segment in leaf.segments:
        if isinstance(segment, int):
            steps.append(F.lit(segment))
            path += f"[{segment}]"
        else:
            siblings = F.json_object_keys(F.get_json_object(text, path))
            steps.append(F.array_position(siblings, segment).cast("int"))
            path += f"['{segment}']"
    return F.array(*steps)


def flatten(
    df: DataFrame,
    column: str,
    leaves: list[Leaf] | None = None,
    *,
    embedded: bool = False,
    clean: bool = False,
    empty_as: str | None = None,
    strict: bool = True,
    **find_options,
) -> DataFrame:
    """Replace `column` by one text column per leaf name.

    embedded: text at the top level that holds a JSON object is flattened too.
    clean:    apply `clean_text` to text values (before embedded text is parsed).
    empty_as: what empty containers become; None keeps their JSON text.
    """
    if leaves is None:
        leaves = find_leaves(df, column, embedded=embedded, clean=clean, strict=strict, **find_options)
    is_variant = isinstance(df.schema[column].dataType, T.VariantType)
    keep = [c for c in df.columns if c != column]
    clash = {leaf.name for leaf in leaves} & set(keep)
    if clash:
        raise ValueError(f"flattened names already exist as columns: {sorted(clash)}")

    document = F.col("__doc")
    # VARIANT keeps keys sorted, so only text input knows the order keys were written in.
    source_text = F.to_json(F.col(column)) if is_variant else F.col(column)
    parsed = df.withColumn("__doc", F.col(column) if is_variant else as_variant(F.col(column), strict))
    # Embedded documents are parsed once each, not once per leaf.
    roots = {leaf.embedded: leaf.segments[:1] for leaf in leaves if leaf.embedded}
    inner = {root: f"__doc_{i}" for i, root in enumerate(sorted(roots))}
    parsed = parsed.withColumns(
        {alias: _embedded_object(value_at(document, roots[root], "variant"), clean) for root, alias in inner.items()}
    ) if inner else parsed

    by_name: dict[str, list[Leaf]] = defaultdict(list)
    for leaf in leaves:
        by_name[leaf.name].append(leaf)

    def one(leaf: Leaf) -> Column:
        if leaf.embedded:
            return _leaf_value(F.col(inner[leaf.embedded]), leaf, False, empty_as)
        value = _leaf_value(document, leaf, clean, empty_as)
        alias = inner.get(leaf.path)
        # Where this text was an embedded object its own leaves hold the content.
        return F.when(F.col(alias).isNull(), value) if alias else value

    def merged(name: str) -> Column:
        places = by_name[name]
        if len(places) == 1 or len({leaf.embedded for leaf in places}) > 1:
            return F.coalesce(*[one(leaf) for leaf in places])
        # Two paths spell one name: the later one in the record wins.
        root = places[0].embedded
        host = F.col(inner[root]) if root else document
        text = value_at(document, roots[root], "string") if root else source_text
        ranked = [
            F.when(
                _get(host, leaf, "variant").isNotNull(),
                F.struct(_position(text, leaf).alias("at"), one(leaf).alias("value")),
            )
            for leaf in places
        ]
        return F.array_max(F.array_compact(F.array(*ranked)))["value"]

    return parsed.select(*keep, *[merged(name).alias(name) for name in by_name])


def blank_empty(df: DataFrame, *columns: str, blank: str = "") -> DataFrame:
    """Empty containers already held as text become `blank`."""
    names = columns or tuple(f.name for f in df.schema if isinstance(f.dataType, T.StringType))
    return df.withColumns(
        {c: F.when(F.col(c).isin(EMPTY_OBJECT, EMPTY_ARRAY), blank).otherwise(F.col(c)) for c in names}
    )
