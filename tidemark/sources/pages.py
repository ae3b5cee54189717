"""Page sets and page slices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.plans.staging import stage

PAGE_LIMIT = 1000
# A piece of a slice is narrowed until it holds so many rows beyond the slice.
NEAR = 50_000
# So many rows are drawn to part a range, into so many parts.
SAMPLE, PARTS = 4_000, 64


def last_page(pages: DataFrame, page: str = "page", limit: int = PAGE_LIMIT, first: int = 0) -> DataFrame:
    """One row: the page a reader stops at, i.e. the first that is short or missing.

    Each page also announces its successor, so a missing page shows up as announced
    but without records; that needs no ordering of the pages.
    """
    sizes = pages.groupBy(F.col(page).cast("bigint").alias("page")).agg(F.count("*").alias("records"))
    announced = F.array(
        F.struct("page", "records"),
        F.struct((F.col("page") + 1).alias("page"), F.lit(0).cast("bigint").alias("records")),
    )
    return (
        sizes.select(F.inline(announced))
        .groupBy("page")
        .agg(F.sum("records").alias("records"))
        .agg(
            F.when(F.min("page") > first, F.lit(first).cast("bigint"))
            .otherwise(F.min(F.when(F.col("records") < limit, F.col("page"))))
            .alias("last_page")
        )
    )


def complete_pages(pages: DataFrame, page: str = "page", limit: int = PAGE_LIMIT) -> DataFrame:
    """The records of all pages up to and including the one the set ends with."""
    return pages.filter(F.col(page) <= last_page(pages, page, limit).scalar())


def number_rows(df: DataFrame, *order: str | Column, name: str = "row_number") -> DataFrame:
    """Global row numbers (from 0) without gathering rows in one task.

    Rows are range-partitioned and sorted, and written with their partition; the only
    thing brought together is one count per partition.
    """
    placed = stage(
        df.sort(*order).withColumns(
            {"__part": F.spark_partition_id(), "__seq": F.monotonically_increasing_id()}
        ),
        "numbered",
    )
    # One row per partition of the sort: at most spark.sql.shuffle.partitions rows.
    sizes = placed.groupBy("__part").agg(F.count("*").alias("n"), F.min("__seq").alias("__base"))
    before = F.coalesce(F.sum("n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__part", "__base", before.alias("__start"))
    return (
        placed.join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + F.col("__seq") - F.col("__base"))
        .drop("__part", "__seq", "__base", "__start")
    )


def _marks(rows: DataFrame, key: str, n: int) -> list:
    """Values of `key` that part `rows` about evenly, from a sample of bounded size; exactness does not hang on them."""
    drawn = rows.select(F.col(key).alias("k")).filter("k IS NOT NULL").sample(min(1.0, SAMPLE / n), seed=n).groupBy("k").agg(F.count("*").alias("w"))
    drawn = drawn.orderBy("k").limit(4 * SAMPLE).collect()
    total, seen, found = sum(r["w"] for r in drawn), 0, []
    for r in drawn:
        seen += r["w"]
        if seen * PARTS >= (len(found) + 1) * total:
            found.append(r["k"])
    return found


def _parts(key: Column, marks: list[Column]) -> list[tuple[Column, bool]]:
    """The ranges that `marks` part a sort key into, in order, and which of them hold one value: null, below the first mark, that mark, between, …"""
    parts = [(key.isNull(), True), (key < marks[0], False)]
    for mark, after in zip(marks, [*marks[1:], None]):
        parts += [(key == mark, True), ((key > mark) if after is None else (key > mark) & (key < after), False)]
    return parts


def _pieces(rows: DataFrame, n: int, keys: list[str], first: int, count: int, near: int) -> list[tuple[DataFrame, list[str], int, int]]:
    """Which rows hold the places `first` to `first + count - 1` of `rows` (n rows): (rows, keys yet to sort by, offset, limit) each, in order."""
    count = min(count, n - first)
    if count <= 0:
        return []
    if n <= near + count or not keys:
        return [(rows, keys, first, count)]
    key = keys[0]
    marks = [F.lit(m).cast(rows.schema[key].dataType) for m in _marks(rows, key, n)]
    if not marks:
        return _pieces(rows, n, keys[1:], first, count, near) if rows.filter(F.col(key).isNotNull()).isEmpty() else [(rows, keys, first, count)]
    parts = _parts(F.col(key), marks)
    number = F.coalesce(*(F.when(inside, F.lit(i)) for i, (inside, _) in enumerate(parts)))
    sizes = {r["part"]: r["n"] for r in rows.groupBy(number.alias("part")).agg(F.count("*").alias("n")).collect()}
    found, at = [], 0
    for i, (inside, one_value) in enumerate(parts):
        size = sizes.get(i, 0)
        if size and at + size > first and at < first + count:
            start = max(first - at, 0)
            found += _pieces(rows.filter(inside), size, keys[1:] if one_value else keys, start, first + count - at - start, near)
        at += size
    return found


def page_slice(df: DataFrame, order: list[str], offset: int, limit: int = PAGE_LIMIT, near: int = NEAR) -> DataFrame:
    """`limit` rows of the ordered set, starting at `offset`.

    Nothing is written, and nothing but the slice's surroundings is sorted to get there.  Counts of the
    ranges of a sort key, each one scan of that column, narrow the table to the ranges
    the slice lies in; a range is a filter on the stored column, so it reaches the
    files.  Where one value of a key holds more than that, its rows are parted by the
    next key.  What is left, the slice and up to `near` rows a piece, is sorted.

    Rows that tie in `order` follow in the order of all their columns, as JSON, so
    slices of one set fit together; only rows equal in every column are interchangeable.
    Nulls come first.  A slice beyond the last row is empty.
    """
    def whole(rows: DataFrame) -> Column:
        return F.to_json(F.struct(*(rows[c] for c in df.columns)))

    slices = []
    for rows, keys, start, count in _pieces(df, df.count(), order, offset, limit, near):
        if keys:
            slices.append(rows.orderBy(*order, whole(rows)).offset(start).limit(count))
            continue
        # One value of every sort key: the rows themselves part them.
        tied = rows.withColumn("__tie", whole(rows))
        for few, left, begin, size in _pieces(tied, tied.count(), ["__tie"], start, count, near):
            slices.append((few.orderBy("__tie") if left else few).offset(begin).limit(size).drop("__tie"))
    if not slices:
        return df.limit(0)
    found = reduce(DataFrame.unionByName, slices)
    return found.orderBy(*order, whole(found))
