"""Packing documents into windows of ids by non-negative least squares."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, staged
from tidemark.llm.tokens import tokenised


def combinations(window: int) -> list[tuple[int, ...]]:
    """Shallow combinations of lengths that fill a window: a + b, and a + b + b."""
    pairs = [(window - b, b) for b in range(1, window // 2 + 1)]
    triples = [(window - 2 * b, b, b) for b in range(1, (window - 1) // 2 + 1)]
    return pairs + triples


def solve(combos: list[tuple[int, ...]], histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|^2, by accelerated projected gradients.

    A has one row per length and one column per combination, with 2 or 3 ones in all.
    """
    rows = np.concatenate([np.array(c) for c in combos])
    columns = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    n = len(histogram)

    def times(x: np.ndarray) -> np.ndarray:
        return np.bincount(rows, weights=x[columns], minlength=n)

    def back(y: np.ndarray) -> np.ndarray:
        return np.bincount(columns, weights=y[rows], minlength=len(combos))

    # Power iterations bound the largest eigenvalue of A'A, hence the step.
    v = np.ones(len(combos))
    for _ in range(30):
        v = back(times(v))
        top = np.linalg.norm(v)
        v /= top
    x = ahead = np.zeros(len(combos))
    weight = 1.0
    for _ in range(steps):
        following = np.maximum(0, ahead - back(times(ahead) - histogram) / (1.05 * top))
        heavier = (1 + np.sqrt(1 + 4 * weight * weight)) / 2
        ahead = following + (weight - 1) / heavier * (following - x)
        x, weight = following, heavier
    return x


@dataclass
class Plan:
    """slots: rows (length, low, high, first, repeat, offset): ranks low <= r < high of that length go to
    sequence first + (r - low) % repeat, at offset.  rest: per length, the ranks from `planned` on are laid end to
    end from `position`, counted in ids from sequence `rest_first`.  full_first: the sequence of the first full window."""

    slots: list[tuple[int, int, int, int, int, int]]
    rest: list[tuple[int, int, int]]
    rest_first: int
    full_first: int
    rest_ids: int


def make_plan(histogram: np.ndarray, window: int) -> Plan:
    """Round the repeat counts to what the histogram holds and lay out the rest greedily, longest first."""
    combos = combinations(window)
    solution = solve(combos, histogram.astype(float))
    left, used, slots, sequence = histogram.astype(np.int64).copy(), np.zeros(len(histogram), np.int64), [], 0
    for c in np.argsort(-solution, kind="stable"):
        combo = combos[c]
        need = {length: combo.count(length) for length in combo}
        repeat = min(int(round(solution[c])), *(int(left[length]) // k for length, k in need.items()))
        if repeat <= 0:
            continue
        offset = 0
        for length in combo:
            slots.append((length, int(used[length]), int(used[length]) + repeat, sequence, repeat, offset))
            used[length] += repeat
            left[length] -= repeat
            offset += length
        sequence += repeat
    rest, position = [], 0
    for length in range(window - 1, 0, -1):
        if left[length]:
            rest.append((length, int(used[length]), position))
            position += length * int(left[length])
    return Plan(slots, rest, sequence, sequence + -(-position // window), position)


def packed(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of documents in sequences of at most `window` ids.

    Returns per piece: doc_id, start (the document's ids before it), length, ids
    (binary, unsigned 32 bits, little-endian), doc_tokens (with the end id),
    sequence_id, offset (its place in the sequence, without gaps), sequence_length,
    padded_length (`window`, or sequence_length where that is a power of two).

    A document's full windows are sequences of their own.  What remains of it is
    shorter than a window: the histogram of these lengths, at most `window` numbers,
    is all the driver sees.  It is covered by shallow combinations that fill a window
    exactly; documents find their slot by their rank within their length.  What the
    rounding leaves is laid end to end, longest first, and cut at window borders, so
    only the last sequence can be short.

    A null text is empty and has the end id alone.  Rows that repeat a doc_id are
    packed each; null doc_ids too.  Other columns are ignored.
    """
    spark = docs.sparkSession
    tokens = staged(tokenised(docs, tokenizer, end_id).withColumn("uid", F.monotonically_increasing_id()), "tokens")
    sizes = tokens.select("uid", "n", (F.col("n") % window).alias("short"), F.expr(f"n div {window}").alias("full"))
    counts = sizes.groupBy("short").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("full")).collect()
    histogram = np.zeros(window, np.int64)
    full = np.zeros(window, np.int64)
    for row in counts:
        histogram[row["short"]], full[row["short"]] = row["n"], row["full"]
    histogram_short = histogram.copy()
    histogram_short[0] = 0
    plan = make_plan(histogram_short, window)
    starts = plan.full_first + np.concatenate([[0], np.cumsum(full)[:-1]])

    # Each length's ranks from `low` on, up to `high`, have one place; the table has at most three rows a combination and one a length.
    never = 1 << 62
    table = [(*s, True) for s in plan.slots] + [(length, planned, never, position, 0, 0, False) for length, planned, position in plan.rest]
    if histogram[0]:
        table.append((0, 0, never, 0, 0, 0, False))
    places = spark.createDataFrame(table, "short long, low long, high long, first long, repeat long, at long, slot boolean")
    bases = spark.createDataFrame([(i, int(starts[i])) for i in range(window) if histogram[i]], "short long, full_first long")

    ranked = numbered(sizes, ["short"], ["uid"], sums=["full"])
    r, low, short = F.col("rank"), F.col("low"), F.col("short")
    laid = F.col("first") + (r - low) * short
    placed = (
        ranked.join(F.broadcast(bases), "short")
        .join(F.broadcast(places), "short")
        .filter((r >= low) & (r < F.col("high")))
        .select(
            "uid",
            (F.col("full_first") + F.col("full_before")).alias("first_full"),
            F.when(F.col("slot"), F.col("first") + (r - low) % F.col("repeat")).otherwise(F.lit(plan.rest_first) + F.floor(laid / window)).cast("long").alias("sequence"),
            F.when(F.col("slot"), F.col("at")).otherwise(laid % window).cast("long").alias("at"),
        )
    )
    last, last_length = plan.full_first - 1, plan.rest_ids % window

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "width", "n", "first_full", "sequence", "at"))):
                doc_id, ids, width, n, first_full, sequence, at = row
                ids = np.frombuffer(ids, f"<u{width}").astype("<u4")
                full = n // window
                pieces = [(i * window, window, first_full + i, 0) for i in range(full)]
                short, start = n - full * window, full * window
                while short:
                    length = min(short, window - at)
                    pieces.append((start, length, sequence, at))
                    start, short, sequence, at = start + length, short - length, sequence + 1, 0
                for start, length, sequence, at in pieces:
                    total = last_length if last_length and sequence == last else window
                    rows.append((doc_id, start, length, ids[start : start + length].tobytes(), n, sequence, at, total, total if total & (total - 1) == 0 else window))
                held += n
                if held > 1 << 21:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    return tokens.join(placed, "uid").select("doc_id", "ids", "width", "n", "first_full", "sequence", "at").mapInArrow(
        cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_length long, padded_length long"
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_length", "padded_length"]
    columns = [pa.array(c, pa.binary() if name == "ids" else pa.int64()) for name, c in zip(names, zip(*rows))]
    return pa.RecordBatch.from_arrays(columns, names)
