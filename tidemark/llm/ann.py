"""Approximate nearest neighbours: NN-descent builds a graph, greedy search walks it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

EDGES = "u long, w long, d float"


def vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, v (array of double): one row per id, without vectors that are null, zero, or hold null, NaN or infinite components.

    Of rows that repeat an id, the vector with the smallest hash counts; rows without id take no part.
    """
    v = F.col("v")
    fit = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    return rows.filter(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(fit, F.lit(False))).groupBy("id").agg(F.min_by("v", F.xxhash64("v")).alias("v"))


def matrix(column: pa.Array, dtype: str) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype).reshape(len(column), -1)


def edges(u: np.ndarray, w: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u.astype(np.int64)), pa.array(w.astype(np.int64)), pa.array(d.astype(np.float32))], ["u", "w", "d"])


def nearest_in_block(ids: np.ndarray, x: np.ndarray, k: int) -> pa.RecordBatch | None:
    """Each row's k nearest others of the block."""
    k = min(k, len(ids) - 1)
    if k < 1:
        return None
    squares = (x * x).sum(1)
    found = []
    for i in range(0, len(ids), 1024):
        d = squares[i : i + 1024, None] + squares[None] - 2 * (x[i : i + 1024] @ x.T)
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        found.append((near, np.take_along_axis(d, near, 1)))
    near, d = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    return edges(np.repeat(ids, k), ids[near.ravel()], d.ravel())


@dataclass
class Settings:
    """neighbours kept per node; reverse neighbours that take part in a local join; candidates per node and join;
    pivots and blocks of the first graph; rounds of NN-descent; pool and rounds of a search."""

    neighbours: int = 40
    reverse: int = 16
    proposals: int = 10
    pivots: int = 32
    near_pivots: int = 6
    block: int = 3072
    descents: int = 1
    pool: int = 150
    rounds: int = 4


@dataclass
class Index:
    """nodes: id (the smallest of equal vectors), v, x (32-bit floats), members (the `keep` smallest ids that share v).
    graph: id, near (ids, 64 bits each), d (squared distances).  entries: ids of the pivots."""

    nodes: DataFrame
    graph: DataFrame
    entries: list[int]
    settings: Settings


def build(rows: DataFrame, settings: Settings | None = None, keep: int = 11) -> Index:
    """An index over `rows` (id, v), all of them.

    Equal vectors are one node.  The first graph joins each node with those of its
    blocks: every node goes to its nearest pivots (a fixed number of nodes, chosen by
    hash), rows are sorted by pivot and distance and cut into blocks of one size, so
    that a crowded pivot is several blocks.  Each round of NN-descent then joins
    every node's neighbours, and reverse neighbours, with each other.
    """
    s = settings or Settings()
    by = Window.partitionBy("_key").orderBy("id")
    keyed = rows.withColumn("_key", F.sha2(F.to_json(F.struct("v")), 256))
    few = keyed.withColumn("_rank", F.row_number().over(by)).filter(F.col("_rank") <= keep)
    classes = few.groupBy("_key").agg(F.min_by("v", "id").alias("v"), F.array_sort(F.collect_list("id")).alias("members"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.array(v, np.float32).tobytes() for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), batch.column("members"), pa.array(x, pa.binary())], ["id", "v", "members", "x"])

    plain = classes.select(F.element_at("members", 1).alias("id"), "v", "members")
    nodes = staged(plain.mapInArrow(pack, "id long, v array<double>, members array<long>, x binary"), "ann-nodes")
    total = nodes.count()
    pivots = nodes.orderBy(F.xxhash64("id"), "id").limit(s.pivots).select("id", "x").collect()
    if not pivots:
        return Index(nodes, nodes.select("id", F.col("x").alias("near"), F.col("x").alias("d")), [], s)
    graph = staged(_nearest(_blocks(nodes, [bytes(p["x"]) for p in pivots], total, s), s.neighbours), "ann-graph")
    for _ in range(s.descents if total > s.block else 0):
        graph = staged(_nearest(_descend(nodes, graph, s), s.neighbours), "ann-graph")
    return Index(nodes, graph, [p["id"] for p in pivots], s)


def _blocks(nodes: DataFrame, pivots: list[bytes], total: int, s: Settings) -> DataFrame:
    centres = np.frombuffer(b"".join(pivots), np.float32).reshape(len(pivots), -1)
    copies = min(s.near_pivots, len(pivots)) if total > s.block else 1

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"), "<f4")
            d = (centres * centres).sum(1)[None] - 2 * (x @ centres.T)
            order = np.argsort(d, axis=1, kind="stable")[:, :copies]
            for m in range(copies):
                pick = order[:, m]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pick.astype(np.int32)), pa.array(d[np.arange(len(x)), pick].astype(np.float32)), batch.column("id"), batch.column("x")], ["pivot", "far", "id", "x"]
                )

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, xs, held = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids.append(batch.column("id").to_numpy())
            xs.append(matrix(batch.column("x"), "<f4"))
            held += batch.num_rows
            while held >= 2 * s.block:
                every, x = np.concatenate(ids), np.concatenate(xs)
                yield nearest_in_block(every[: s.block], x[: s.block], s.neighbours)
                ids, xs, held = [every[s.block :]], [x[s.block :]], held - s.block
        if held and (found := nearest_in_block(np.concatenate(ids), np.concatenate(xs), s.neighbours)):
            yield found

    dealt = nodes.select("id", "x").mapInArrow(assign, "pivot int, far float, id long, x binary")
    tasks = max(1, total * copies // (4 * s.block))
    return dealt.repartitionByRange(tasks, "pivot", "far", "id").sortWithinPartitions("pivot", "far", "id").mapInArrow(near, EDGES)


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """The k nearest different w of each u, as one row."""

    def merge(u: np.ndarray, w: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
        first = np.ones(len(u), bool)
        first[1:] = (u[1:] != u[:-1]) | (w[1:] != w[:-1])
        u, w, d = u[first], w[first], d[first]
        order = np.lexsort((w, d, u))
        u, w, d = u[order], w[order], d[order]
        begin = np.flatnonzero(np.append(True, u[1:] != u[:-1]))
        rank = np.arange(len(u)) - np.repeat(begin, np.diff(np.append(begin, len(u))))
        u, w, d = u[rank < k], w[rank < k], d[rank < k]
        begin = np.flatnonzero(np.append(True, u[1:] != u[:-1]))
        ends = np.append(begin[1:], len(u))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(u[begin]),
                pa.array([w[b:e].astype("<i8").tobytes() for b, e in zip(begin, ends)], pa.binary()),
                pa.array([d[b:e].astype("<f4").tobytes() for b, e in zip(begin, ends)], pa.binary()),
            ],
            ["id", "near", "d"],
        )

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by u; the last u of a batch may go on in the next one.
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)]
        for batch in batches:
            held = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if cut > 50_000:
                yield merge(*(h[:cut] for h in held))
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield merge(*held)

    return found.repartition("u").sortWithinPartitions("u", "w", "d").mapInArrow(top, "id long, near binary, d binary")


def _edges(graph: DataFrame) -> DataFrame:
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = [np.frombuffer(b, "<i8") for b in batch.column("near").to_pylist()]
                ids = np.repeat(batch.column("id").to_numpy(), [len(n) for n in near])
                yield edges(ids, np.concatenate(near), np.frombuffer(b"".join(batch.column("d").to_pylist()), "<f4"))

    return graph.select("id", "near", "d").mapInArrow(spread, EDGES)


def _descend(nodes: DataFrame, graph: DataFrame, s: Settings) -> DataFrame:
    """The graph's edges and what the local joins propose: pairs among a node's neighbours that are nearer than a member's farthest neighbour."""
    every = _edges(graph)
    by = Window.partitionBy("w").orderBy("d", "u")
    back = every.withColumn("_rank", F.row_number().over(by)).filter(F.col("_rank") <= s.reverse).select(F.col("w").alias("at"), F.col("u").alias("m"))
    pairs = every.select(F.col("u").alias("at"), F.col("w").alias("m")).union(back)
    far = graph.select("id", F.expr("substring(d, octet_length(d) - 3, 4)").alias("far"))
    members = pairs.join(nodes.select("id", "x").join(far, "id").withColumnRenamed("id", "m"), "m")

    def join(at: np.ndarray, m: np.ndarray, far: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        begin = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        sizes = np.diff(np.append(begin, len(at)))
        width = int(sizes.max())
        place = np.arange(len(at)) - np.repeat(begin, sizes)
        group = np.repeat(np.arange(len(begin)), sizes)
        ids, limit = np.full((len(begin), width), -1, np.int64), np.zeros((len(begin), width), np.float32)
        wide = np.zeros((len(begin), width, x.shape[1]), np.float32)
        ids[group, place], limit[group, place], wide[group, place] = m, far, x
        squares = (wide * wide).sum(2)
        d = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(wide, wide.transpose(0, 2, 1))
        d[(ids[:, :, None] == ids[:, None, :]) | (ids[:, None, :] < 0)] = np.inf
        k = min(s.proposals, width - 1)
        if k < 1:
            return
        near = np.argpartition(d, k - 1, axis=2)[:, :, :k]
        d = np.take_along_axis(d, near, 2)
        w = np.take_along_axis(np.broadcast_to(ids[:, None, :], (*ids.shape, width)), near, 2)
        good = (d < limit[:, :, None]) & (ids[:, :, None] >= 0)
        yield edges(np.broadcast_to(ids[:, :, None], w.shape)[good], w[good], d[good])

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column("at").to_numpy(), batch.column("m").to_numpy(), matrix(batch.column("far"), "<f4")[:, 0], matrix(batch.column("x"), "<f4")]
            held = new if held is None else [np.concatenate(p) for p in zip(held, new)]
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut > 0:
                yield from join(*(h[:cut] for h in held))
                held = [h[cut:] for h in held]
        if held is not None:
            yield from join(*held)

    proposed = members.select("at", "m", "far", "x").repartition("at").sortWithinPartitions("at", "m").mapInArrow(propose, EDGES)
    return every.union(proposed)


def search(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """Per query (id, v): query_id, rank (from 1), id, distance (Euclidean, in doubles) of the k nearest rows found, ties to the smaller id.

    Greedy best-first search: each query's pool starts with the pivots and, if its
    vector is in the index, that node; in every round all of the pool that was not
    followed yet is, and the nearest are kept.  A row is never its own neighbour.
    Candidates travel to their vectors, not the reverse.
    """
    s = index.settings
    spark = queries.sparkSession
    if not index.entries:
        return queries.selectExpr("id AS query_id", "1 AS rank", "id", "CAST(0 AS double) AS distance").filter(F.lit(False))
    asked = staged(queries.select(F.col("id").alias("q"), F.col("v").alias("qv"), F.sha2(F.to_json(F.struct("v")), 256).alias("_key")), "ann-queries")
    home = asked.join(index.nodes.select(F.col("id").alias("n"), F.sha2(F.to_json(F.struct("v")), 256).alias("_key")), "_key").select("q", "n")
    entries = spark.createDataFrame([(e,) for e in index.entries], "n long")
    new = asked.select("q").join(F.broadcast(entries)).union(home).distinct()
    pool = None
    by = Window.partitionBy("q").orderBy("d", "n")
    near = F.col("near")
    for turn in range(s.rounds + 1):
        measured = _measured(index, asked, new)
        both = measured.withColumn("followed", F.lit(False)) if pool is None else measured.withColumn("followed", F.lit(False)).unionByName(pool)
        best = both.groupBy("q", "n").agg(F.min("d").alias("d"), F.max("followed").alias("followed"))
        ranked = staged(best.withColumn("_rank", F.row_number().over(by)).filter(F.col("_rank") <= s.pool).drop("_rank"), "ann-pool")
        pool = ranked.withColumn("followed", F.lit(True)).select("q", "n", "d", "followed")
        if turn == s.rounds:
            break
        frontier = ranked.filter(~F.col("followed")).select("q", F.col("n").alias("id"))
        steps = _followed(frontier.join(index.graph.select("id", near), "id")).distinct()
        new = steps.join(pool.select("q", "n"), ["q", "n"], "left_anti")
    # Classes of equal vectors give their members; k + 1 classes hold k rows besides the query itself.
    classes = pool.withColumn("_rank", F.row_number().over(by)).filter(F.col("_rank") <= k + 1)
    rows = classes.join(index.nodes.select(F.col("id").alias("n"), "members"), "n").select("q", "d", F.explode("members").alias("id")).filter("id <> q")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "id"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).select(F.col("q").alias("query_id"), "rank", "id", F.col("d").alias("distance"))


def _followed(frontier: DataFrame) -> DataFrame:
    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = [np.frombuffer(b, "<i8") for b in batch.column("near").to_pylist()]
                q = np.repeat(batch.column("q").to_numpy(), [len(n) for n in near])
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(np.concatenate(near))], ["q", "n"])

    return frontier.select("q", "near").mapInArrow(follow, "q long, n long")


def _measured(index: Index, asked: DataFrame, pairs: DataFrame) -> DataFrame:
    """q, n, d: exact distances of pairs, in doubles."""
    both = pairs.join(index.nodes.select(F.col("id").alias("n"), "v"), "n").join(asked.select("q", "qv"), "q")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (batch.column(c).flatten().to_numpy().reshape(batch.num_rows, -1) for c in ("v", "qv"))
            d = np.sqrt(((a - b) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("n"), pa.array(d)], ["q", "n", "d"])

    return both.select("q", "n", "v", "qv").mapInArrow(measure, "q long, n long, d double")


def neighbours(table: DataFrame, id_column: str, vector_column: str, every: int, k: int = 10, settings: Settings | None = None) -> DataFrame:
    """query_id, rank, id, distance: the k nearest rows found of each row whose id is divisible by `every`.

    All vectors have one length.  An empty table, or one without usable vectors, gives an empty result.
    """
    rows = staged(vectors(table, id_column, vector_column), "ann-rows")
    index = build(rows, settings, keep=k + 1)
    return search(index, rows.filter(F.col("id") % every == 0), k)
