"""Whitening of vectors: pivoted Cholesky of their scatter, then one-sided Jacobi on the factor."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

WIDE = pa.decimal128(38, 0)
# Whole numbers of at most this size are added and multiplied in 64 bits.
SAFE = float(2**62)


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """L (d x rank) with L L' = `scatter`, rows in the order of `scatter`; taking rows in pivot order gives a triangle.

    The largest remaining diagonal entry is the next pivot; what is left below rounding
    error of the largest one is rank that the data do not have.
    """
    size = len(scatter)
    left = scatter.diagonal().astype(np.float64).copy()
    factor, used = np.zeros((size, size)), np.zeros(size, dtype=bool)
    least = left.max(initial=0.0) * size * np.finfo(np.float64).eps
    for k in range(size):
        pivot = int(np.argmax(np.where(used, -1.0, left)))
        if not left[pivot] > least:
            return factor[:, :k]
        column = scatter[:, pivot] - factor[:, :k] @ factor[pivot, :k]
        # Rows that were pivots are zero from here on: the factor is a permuted triangle.
        factor[:, k] = np.where(used, 0.0, column / np.sqrt(left[pivot]))
        factor[pivot, k] = np.sqrt(left[pivot])
        used[pivot] = True
        left = np.where(used, 0.0, np.maximum(left - factor[:, k] ** 2, 0.0))
    return factor


def rounds(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Disjoint pairs of columns, every pair once: a round-robin tournament."""
    players = list(range(size)) + ([-1] if size % 2 else [])
    half, found = len(players) // 2, []
    for _ in range(len(players) - 1):
        pairs = [(min(a, b), max(a, b)) for a, b in zip(players[:half], reversed(players[half:])) if a >= 0 and b >= 0]
        if pairs:
            found.append((np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])))
        players = [players[0], players[-1], *players[1:-1]]
    return found


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of factor @ factor.T, by falling eigenvalue.

    Plane rotations make the columns orthogonal, all disjoint pairs of a round at once;
    then a column's squared norm is an eigenvalue and the column, normalised, its vector.
    """
    work = np.array(factor, dtype=np.float64)
    order = rounds(work.shape[1])
    for _ in range(sweeps):
        turned = False
        for a, b in order:
            x, y = work[:, a], work[:, b]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > 1e-15 * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                zeta = (yy - xx) / (2 * xy)
                tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            tangent = np.where(turn & np.isfinite(tangent), tangent, 0.0)
            cosine = 1 / np.sqrt(1 + tangent * tangent)
            sine = cosine * tangent
            work[:, a], work[:, b] = cosine * x - sine * y, sine * x + cosine * y
        if not turned:
            break
    values = (work * work).sum(0)
    rank = np.argsort(-values, kind="stable")
    return values[rank], work[:, rank] / np.sqrt(values[rank])


def whole_vectors(rows: DataFrame, vector: str, *columns: Column) -> DataFrame:
    """`columns` and `x` (whole numbers) of the rows whose vector is present and has only finite entries."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    # Beyond 2^61 / 1024 an entry counts as that.
    whole = F.transform(v, lambda c: F.floor(F.greatest(F.least(c * 1024.0, F.lit(2.0**61)), F.lit(-(2.0**61)))).cast("long") + 100000)
    return rows.filter(v.isNotNull() & finite).select(*columns, whole.alias("x"))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return np.asarray(batch.column("x").flatten().to_numpy(zero_copy_only=False), dtype=np.int64).reshape(-1, size)


def sums(vectors: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension: a row per task and dimension is shuffled."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(size, dtype=object)
        for batch in batches:
            x = _matrix(batch, size)
            count += len(x)
            small = float(np.abs(x.astype(np.float64)).max(initial=0.0)) * max(len(x), 1) < SAFE
            total = total + (x.sum(0).astype(object) if small else x.astype(object).sum(0))
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size), pa.int32()), pa.array([Decimal(int(t)) for t in total], WIDE), pa.array([count] * size, pa.int64())], ["dim", "total", "n"]
            )

    parts = vectors.select("x").mapInArrow(partial, "dim int, total decimal(38,0), n long")
    found = parts.groupBy("dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    total = [0] * size
    for r in found:
        total[r["dim"]] = int(r["total"])
    return (found[0]["n"] if found else 0), total


def scatter(vectors: DataFrame, mean: np.ndarray) -> np.ndarray:
    """Sum over the vectors of (x - mean)(x - mean)': centred before multiplying, a matrix row per task is shuffled."""
    size = len(mean)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((size, size)), False
        for batch in batches:
            y = _matrix(batch, size) - mean
            total += y.T @ y
            seen = True
        if seen:
            at = np.repeat(np.arange(size, dtype=np.int32), size), np.tile(np.arange(size, dtype=np.int32), size)
            yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(total.ravel())], ["i", "j", "v"])

    parts = vectors.select("x").mapInArrow(partial, "i int, j int, v double")
    out = np.zeros((size, size))
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    out[found["i"], found["j"]] = found["v"]
    return (out + out.T) / 2


def whiten(rows: DataFrame, key: str, vector: str, components: int = 8) -> DataFrame:
    """Per remaining row and component: `key`, component, n, deviation, deviation_wide, whitened, explained, identity_error.

    All remaining vectors are the fit list.  Two passes give the exact sums and the centred
    scatter, combined per task; the driver factors that matrix, whose size is the
    squared dimension whatever the number of rows, and the basis goes to the tasks.  A third
    pass projects, and the covariance of what it wrote is checked over all rows.

    Rows with a null vector, or a null or non-finite entry, are dropped.  A table's dimension
    is the length that most remaining vectors have (of equally frequent ones the larger);
    vectors of other lengths are dropped too, and so are empty ones.  Fewer components are returned
    where the vectors span fewer dimensions: a component without variance cannot be whitened, so equal
    vectors, a single one, and an empty table give an empty result.  Rows that repeat a key, and null
    keys, count each.  `deviation` is null where it takes more than 64 bits, `deviation_wide` holds it
    up to 38 digits.  Entries beyond 2^61 / 1024 count as that.
    """
    spark = rows.sparkSession
    schema = "key long, component int, n long, deviation long, deviation_wide decimal(38,0), whitened double, explained double, identity_error double"
    vectors = staged(whole_vectors(rows, vector, F.col(key).cast("long").alias("key")).filter(F.size("x") > 0), "vectors")
    common = vectors.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    empty = spark.createDataFrame([], schema).withColumnRenamed("key", key)
    if common is None:
        return empty
    size = common["size"]
    vectors = vectors.filter(F.size("x") == size)
    n, total = sums(vectors, size)
    mean = np.array([t / n for t in total])
    values, basis = one_sided_jacobi(pivoted_cholesky(scatter(vectors, mean) / n))
    trace, keep = float(values.sum()), min(components, len(values))
    if not keep:
        return empty
    axes = basis[:, :keep] / np.sqrt(values[:keep])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, size)
            white = (x - mean) @ axes
            reach = float(np.abs(x.astype(np.float64)).max(initial=0.0)) * n + max(map(abs, total))
            if reach * reach * size < SAFE:
                off = x * n - np.array(total, dtype=np.int64)
                far = (off * off).sum(1).tolist()
            else:
                off = x.astype(object) * n - np.array(total, dtype=object)
                far = (off * off).sum(1).tolist()
            narrow = [f if f < 2**63 else None for f in far]
            wide = [Decimal(f) if f < 10**38 else None for f in far]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(narrow, pa.int64()), pa.array(wide, WIDE), pa.array(list(white), pa.list_(pa.float64()))], ["key", "deviation", "deviation_wide", "white"]
            )

    done = staged(vectors.mapInArrow(project, "key long, deviation long, deviation_wide decimal(38,0), white array<double>"), "whitened")
    middle = done.agg(*(F.avg(F.col("white")[i]).alias(str(i)) for i in range(keep))).first()
    pairs = [(i, j) for i in range(keep) for j in range(i, keep)]
    off = done.agg(*(F.avg((F.col("white")[i] - middle[i]) * (F.col("white")[j] - middle[j])).alias(f"{i}_{j}") for i, j in pairs)).first()
    error = max(abs(off[f"{i}_{j}"] - (i == j)) for i, j in pairs)
    explained = F.array(*(F.lit(float(v) / trace) for v in values[:keep]))
    return done.select("key", "deviation", "deviation_wide", F.posexplode("white").alias("_at", "whitened")).select(
        F.col("key").alias(key), (F.col("_at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("_at")).alias("explained"), F.lit(float(error)).alias("identity_error"), "deviation_wide",
    )
