"""Near-duplicates by a chosen-path similarity join over word shingles."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keeping_columns, small_batches, staged, staying
from tidemark.llm.components import components

_RANDOM = np.random.default_rng(20240101)
_BYTES = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
_UNBASE = pow(_BASE, -1, 1 << 64)
# Of a set's histogram, a power of two.
_BUCKETS = 256
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True


@dataclass
class Settings:
    """words a shingle; percent of similarity to link at; independent trees; levels of a tree; the level whose
    nodes are looked at first; rows that a node is compared exhaustively from; the estimate from which a pair may be confirmed on its full sets; how many standard
    deviations more than the threshold allows two sets may seem to differ by; trees of the first round; the least buckets of the
    filters on what is fetched; the share of pairs at the threshold that the trees may miss; tokens of a row's brief, and the estimate
    by briefs from which two rows' profiles are compared."""

    words: int = 5
    percent: int = 80
    trees: int = 12
    levels: int = 8
    first_level: int = 2
    small: int = 64
    estimate: float = 0.64
    deviations: float = 5.0
    first_trees: int = 4
    buckets: int = 1 << 18
    miss: float = 2e-4
    brief: int = 32
    brief_estimate: float = 0.35

    @property
    def tokens(self) -> int:
        return self.trees * self.levels

    def log_miss(self, depth: int) -> float:
        """Logarithm of the probability that a tree looked at from `depth` on misses a pair at the threshold."""
        return math.log(max(1e-300, 1 - (self.percent / 100) ** depth))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """64-bit hashes of a text's distinct shingles; words are bytes between ASCII white space, A-Z in lower case.

    A word's hash is a polynomial of random numbers for its bytes, from differences of running sums.
    """

    def __init__(self, words: int, piece: int = 1 << 20):
        self.words, self.piece = words, piece
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, 1 << 14)
            steps = np.full((2, size), np.array([[_BASE], [_UNBASE]], np.uint64))
            steps[:, 0] = 1
            self.powers, self.inverse = np.cumprod(steps, axis=1, dtype=np.uint64)

    def _words(self, data: np.ndarray) -> np.ndarray:
        edge = np.diff(np.concatenate([[True], _WHITE[data], [True]]).astype(np.int8))
        begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self._grow(len(data) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * self.powers[: len(data)], dtype=np.uint64)])
        return mix((sums[end] - sums[begin]) * self.inverse[begin] + (end - begin).astype(np.uint64))

    def word_hashes(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
        parts, at = [], 0
        while len(data) - at > self.piece:
            # A long text is read in pieces that end at white space.
            end, step = at + self.piece, self.piece
            while end < len(data) and not (gap := np.flatnonzero(_WHITE[data[end : end + step]])).size:
                end += step
            end = min(len(data), end + int(gap[0])) if end < len(data) else len(data)
            parts.append(self._words(data[at:end]))
            at = end
        parts.append(self._words(data[at:]))
        return np.concatenate(parts)

    def __call__(self, text: str | None) -> np.ndarray:
        words = self.word_hashes(text or "")
        n = min(self.words, len(words))
        if not n:
            return words
        found = words[: len(words) - n + 1]
        for i in range(1, n):
            found = mix(found * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - n + 1 + i])
        return np.unique(found)


def signature(shingles: np.ndarray, tokens: int, turn: int = 0) -> np.ndarray:
    """The minwise token of a set under each of `tokens` hash functions, others each `turn`, as 16-bit numbers."""
    random = np.random.default_rng(7 + turn)
    factors = random.integers(0, 1 << 63, tokens, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    best = np.full(tokens, (1 << 64) - 1, np.uint64)
    for i in range(0, len(shingles), 4096):
        part = shingles[i : i + 4096, None] * factors
        best = np.minimum(best, (part ^ (part >> np.uint64(32))).min(axis=0))
    return (mix(best) >> np.uint64(48)).astype(np.uint16)


def histogram(shingles: np.ndarray) -> np.ndarray:
    """How many shingles end in each byte, modulo 256."""
    return np.bincount((shingles & np.uint64(_BUCKETS - 1)).astype(np.int64), minlength=_BUCKETS).astype(np.uint8)


def sketched(docs: DataFrame, s: Settings) -> DataFrame:
    """One row per row of `docs`: doc_id, mark (of the text), n, and of a set that is not empty cls (a digest), high and low (bytes of its tokens), histogram."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(s.words)
        for batch in batches:
            sizes, classes, high, low, histograms = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingler(text)
                sizes.append(len(found))
                classes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                chosen = signature(found, s.tokens)
                high.append((chosen >> 8).astype(np.uint8).tobytes() if len(found) else None)
                low.append(chosen.astype(np.uint8).tobytes() if len(found) else None)
                histograms.append(histogram(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(sizes, pa.int64()), *(pa.array(c, pa.binary()) for c in (classes, high, low, histograms))],
                ["doc_id", "mark", "n", "cls", "high", "low", "histogram"],
            )

    return _texts(docs).mapInArrow(sketch, "doc_id long, mark long, n long, cls binary, high binary, low binary, histogram binary")


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _tokens(batch: pa.RecordBatch) -> np.ndarray:
    high, low = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("high", "low"))
    return high.astype(np.uint16) << 8 | low


def paths(owned: DataFrame, s: Settings) -> DataFrame:
    """id, component, the tree node (a hash of the minwise tokens chosen so far) at the first level and the tokens left, for each tree."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _tokens(batch)
            for tree in range(s.trees):
                node = np.full(len(tokens), tree + 1, np.uint64)
                first = tree * s.levels + s.first_level
                for i in range(tree * s.levels, first):
                    node = mix(node * np.uint64(0xD6E8FEB86659FD93) + tokens[:, i])
                left = [t.tobytes() for t in tokens[:, first : (tree + 1) * s.levels]]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("component"), pa.array(node.view(np.int64)), pa.array(left, pa.binary())], ["id", "component", "node", "left"])

    return owned.select("id", F.xxhash64("component").alias("component"), "high", "low").mapInArrow(choose, "id long, component long, node long, left binary")


def similarity(sketches: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity; bytes agree by chance once in 256."""
    agree = np.empty((len(sketches), len(others)), np.float32)
    step = max(1, (1 << 22) // max(1, others.size))
    for i in range(0, len(sketches), step):
        agree[i : i + step] = (sketches[i : i + step, None, :] == others[None]).mean(axis=2)
    return (agree - 1 / 256) / (1 - 1 / 256)


def may_reach(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, s: Settings) -> np.ndarray:
    """Which pairs may reach the threshold, by their histograms (a row a pair) and the sizes of their sets.

    What two sets share cancels out in the difference of their histograms.  Its absolute
    sum is never more than the number of elements they differ in; its squared sum
    is close to that number where both have so many that buckets collide.  Counts
    are kept modulo 256: a difference that wraps looks smaller, never larger.
    """
    most = (n + m) * (100 - s.percent) // (100 + s.percent)
    apart = (x - y).view(np.int8).astype(np.int32)
    drift = (n - m) / _BUCKETS
    spread = np.sqrt(2.0 * most * most / _BUCKETS + most + 4 * drift * drift * most)
    return (np.abs(apart).sum(axis=1) <= most) & ((apart * apart).sum(axis=1) <= most + drift * drift * _BUCKETS + s.deviations * spread)


def forest(estimates: np.ndarray, least: float) -> list[tuple[int, int]]:
    """The pairs of a maximum spanning forest, by estimate."""
    i, j = np.nonzero(np.triu(estimates >= least, 1))
    top = list(range(len(estimates)))

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    found = []
    for k in np.argsort(-estimates[i, j], kind="stable"):
        x, y = root(int(i[k])), root(int(j[k]))
        if x != y:
            top[y] = x
            found.append((int(i[k]), int(j[k])))
    return found


def _pairs(a: list[bytes], b: list[bytes]) -> pa.RecordBatch:
    low, high = zip(*((x, y) if x < y else (y, x) for x, y in zip(a, b))) if a else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(low, pa.binary()), pa.array(high, pa.binary())], ["a", "b"])


def first_pairs(nodes: DataFrame, s: Settings) -> DataFrame:
    """Pairs that link most of what is similar: the deepest nodes of a few trees, in order of their paths.

    Rows sorted by path stand next to those they share most of it with; each run of
    `small` rows gives a spanning forest of its pairs.  A node of any size is so
    many runs, and no run gives more pairs than it has rows.
    """

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _tokens(batch)
            for tree in range(s.first_trees):
                chosen = tokens[:, tree * s.levels : (tree + 1) * s.levels].astype(">u2")
                # The first token decides the task's share by hash, the rest the order.
                lead = mix(chosen[:, 0].astype(np.uint64) + np.uint64(tree << 40)).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(lead), pa.array([c.tobytes() for c in chosen], pa.binary()), batch.column("low")], ["cls", "lead", "path", "sketch"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, bytes]] = []

        def flush(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
            sketches = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), -1)
            found = forest(similarity(sketches, sketches), s.estimate) if len(rows) > 1 else []
            return _pairs([rows[i][1] for i, _ in found], [rows[j][1] for _, j in found])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("lead", "cls", "sketch"))):
                if held and row[0] != held[0][0]:
                    if len(held) > 1:
                        yield flush(held)
                    held = []
                held.append(row)
                if len(held) == s.small:
                    yield flush(held)
                    # The last row starts the next run, which ties the runs together.
                    held = held[-1:]
        if len(held) > 1:
            yield flush(held)

    rows = nodes.select("cls", "high", "low").mapInArrow(order, "cls binary, lead long, path binary, sketch binary")
    return rows.repartitionByRange("lead", "path").sortWithinPartitions("lead", "path").mapInArrow(link, "a binary, b binary").distinct()


def path_pairs(nodes: DataFrame, labels: DataFrame, s: Settings, more: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Pairs of different components, from `trees` trees, that may reach the threshold; cls and lost of the rows that need more trees.

    `more` (cls, lost, path_high, path_low) has the rows of further trees and their
    tokens; without it, all rows and their first tokens are taken.  lost is the logarithm
    of the probability that all of a row's trees so far miss a pair at the threshold, by
    the depth at which each was compared or had one component; rows stay while it
    is above that of `miss`.

    A node is compared once the rows outside its largest component are few; else its
    rows branch on by their next minwise token.  In a compared node these few meet
    all others, in pieces of fixed size; rows of one component need not meet.  At
    the last level every node left is compared, the rows outside its largest
    component in several lots.  Rows whose first node has one component have nobody to meet.

    The nodes of all levels are counted at once, by (node, component), so a large group is one
    count a node.  Fewer rows lie outside the largest component the deeper a node is: a
    path has one node at which it ends, and gives one row to what is compared there.  A first node of
    no more than `small` rows never branches, so its deeper levels are not counted.  Levels only say
    who meets whom, by 64-bit hashes of classes and components; what pairs are
    weighed by is joined to that once, for all rows whose briefs leave them somebody to be compared with.
    """
    owned = nodes if more is None else among(nodes, F.xxhash64("cls"), more.select(F.xxhash64("cls").alias("hash")), s)[0].join(more, "cls")
    # Only rows that may have a label are shuffled to find it.
    linked, alone = among(owned, F.xxhash64("cls"), labels.select(F.xxhash64("node").alias("hash")), s)
    linked = linked.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    columns = [F.xxhash64("cls").alias("id"), "cls", "component", "n", "high", "low", "histogram"]
    if more is not None:
        columns += ["lost", "path_high", "path_low"]
    owned = staged(linked.unionByName(alone.withColumn("component", F.col("cls"))).select(*columns), "near-owned")
    chosen = owned if more is None else owned.select("id", "component", F.col("path_high").alias("high"), F.col("path_low").alias("low"))
    rows = paths(chosen, s)
    ends = rows.groupBy("node").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("crowd"))
    rows = staged(rows.join(ends.filter("least < most").select("node", "crowd"), "node"), "near-paths")
    steps = _steps(rows, s)
    shares = steps.groupBy("node", "component").agg(F.count(F.lit(1)).alias("n"), F.any_value("level").alias("level"))
    sizes = shares.groupBy("node").agg(F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("top"), F.any_value("level").alias("level"))
    sizes = sizes.select("node", "level", "all", F.col("top.component").alias("largest"), (F.col("all") - F.col("top.n")).alias("rest"))
    sizes = staged(sizes.filter("rest > 0"), "near-nodes")
    branches = (F.col("rest") > s.small) & (F.col("level") < s.levels)
    deep = sizes.filter(branches).select("node")
    # Each path ends at one node: the first that does not branch on.
    crowded = F.col("crowd") > s.small
    passed = steps.filter(F.col("level") > s.first_level).join(deep.withColumnRenamed("node", "above"), "above", "left_semi")
    at_first = rows.select("id", "component", F.lit(s.first_level).alias("level"), "node", "crowd")
    lasting = at_first.filter(crowded).drop("crowd")
    lasting = lasting.unionByName(passed.select(lasting.columns)).join(deep, "node", "left_anti").select(lasting.columns)
    ends = staged(at_first.filter(~crowded).drop("crowd").unionByName(lasting), "near-ends")
    meeting = _meeting(ends.drop("level"), sizes.filter(~branches).drop("level"), s)
    pairs = staged(_compared(meeting, owned, s).distinct(), "near-pairs")
    missed = F.element_at(F.array(*(F.lit(s.log_miss(level) - s.log_miss(s.first_level)) for level in range(s.first_level, s.levels + 1))), F.col("level") - s.first_level + 1)
    gone = ends.filter(F.col("level") > s.first_level).groupBy("id").agg(F.sum(missed).alias("by"))
    before = F.lit(0.0) if more is None else F.col("lost")
    lost = (before + s.trees * s.log_miss(s.first_level) + F.col("by")).alias("lost")
    owing = owned.join(gone, "id").select("cls", lost).filter(F.col("lost") > math.log(s.miss))
    return pairs, staged(owing, "near-owing")


def _steps(rows: DataFrame, s: Settings) -> DataFrame:
    """id, component, level, node, above (the node's parent): the nodes of each path, from the first level on, and only that where its `crowd` is small."""
    chain = rows.withColumn(f"_{s.first_level}", F.col("node"))
    for level in range(s.first_level + 1, s.levels + 1):
        token = F.substring("left", 2 * (level - s.first_level) - 1, 2)
        chain = chain.withColumn(f"_{level}", F.xxhash64(f"_{level - 1}", token))
    levels = range(s.first_level, s.levels + 1)
    steps = [F.struct(F.lit(level).alias("level"), F.col(f"_{level}").alias("node"), F.col(f"_{max(level - 1, s.first_level)}").alias("above")) for level in levels]
    every = chain.select("id", "component", "crowd", F.inline(F.array(*steps)))
    return every.filter((F.col("level") == s.first_level) | (F.col("crowd") > s.small)).drop("crowd")


def _meeting(labelled: DataFrame, ready: DataFrame, s: Settings) -> DataFrame:
    """node, piece, lot, id, asks: in each of a node's pieces and lots, the rows that ask are compared with the others."""
    piece, lot = 1024, s.small
    rows = labelled.join(ready, "node").withColumn("few", F.col("component") != F.col("largest"))
    pieces = F.ceil(F.col("all") / piece).cast("int")
    lots = F.ceil(F.col("rest") / lot).cast("int")
    place = F.xxhash64("id", "node")
    own_lot = F.pmod(place, lots)
    # Every row is in one piece, with each lot; a row of the few is also asked for in its lot, with each piece.
    members = rows.select(
        "node", "id", F.pmod(F.xxhash64(place), pieces).alias("piece"), F.explode(F.sequence(F.lit(0), lots - 1)).alias("lot"), F.lit(False).alias("asks")
    )
    asking = rows.filter("few").select("node", "id", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"), own_lot.alias("lot"), F.lit(True).alias("asks"))
    return members.withColumn("piece", F.col("piece").cast("long")).unionByName(asking.select("node", "id", F.col("piece").cast("long").alias("piece"), F.col("lot").cast("int").alias("lot"), "asks"))


def _groups(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[list[tuple]]:
    """The rows, of `columns`, of each node, piece and lot; they come in order."""
    key, group = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("node", "piece", "lot", *columns))):
            if row[:3] != key:
                if group:
                    yield group
                key, group = row[:3], []
            group.append(row[3:])
    if group:
        yield group


def _bytes(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)


def _sizes_allow(n: list[int], m: list[int], s: Settings) -> np.ndarray:
    """Sets whose sizes differ too much cannot reach the threshold."""
    x, y = np.array(n, np.int64)[:, None], np.array(m, np.int64)[None]
    return 100 * np.minimum(x, y) >= s.percent * np.maximum(x, y)


_AT = ["node", "piece", "lot"]


def _hopeful(meeting: DataFrame, owned: DataFrame, s: Settings) -> DataFrame:
    """The rows of `meeting` that meet at least one of another component with a brief like theirs.

    A brief is a row's last `brief` bytes of tokens; two sets at the threshold agree in
    too few of 32 of them less than once in 10^7.  Rows are told, not pairs, so these are never more than came.
    """
    width = min(s.brief, s.tokens)
    brief = owned.select("id", F.xxhash64("component").alias("component"), "n", F.substring("low", s.tokens - width + 1, width).alias("brief"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_())

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)], [*_AT, "id", "asks"])

        kept = []
        for group in _groups(batches, (*_AT, "id", "asks", "component", "n", "brief")):
            asks, others = ([r for r in group if r[4] == a] for a in (True, False))
            if not asks or not others:
                continue
            x, y = (_bytes([r[7] for r in part]) for part in (asks, others))
            c, d = (np.array([r[5] for r in part], np.int64) for part in (asks, others))
            hope = (c[:, None] != d[None]) & _sizes_allow([r[6] for r in asks], [r[6] for r in others], s) & (similarity(x, y) >= s.brief_estimate)
            kept += [part[i][:5] for part, axis in ((asks, 1), (others, 0)) for i in np.flatnonzero(hope.any(axis=axis))]
            if len(kept) > 10_000:
                yield batch_of(kept)
                kept = []
        yield batch_of(kept)

    return meeting.join(brief, "id").repartition(*_AT).sortWithinPartitions(*_AT).mapInArrow(keep, "node long, piece long, lot int, id long, asks boolean")


def _compared(meeting: DataFrame, owned: DataFrame, s: Settings) -> DataFrame:
    """The pairs of different components that meet and may reach the threshold."""
    meeting = staged(_hopeful(meeting, owned, s), "near-meeting")
    # Profiles go only to the rows that are compared.
    compared = among(owned, F.col("id"), meeting.select(F.col("id").alias("hash")), s)[0]
    meeting = meeting.join(compared.select("id", "cls", "component", "n", F.concat("low", "histogram").alias("profile")), "id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in _groups(batches, ("cls", "component", "profile", "asks", "n")):
            asks, others = ([r for r in group if r[3] == asked] for asked in (True, False))
            if not asks or not others:
                continue
            x, y = (_bytes([r[2] for r in part]) for part in (asks, others))
            n, m = (np.array([r[4] for r in part], np.int64) for part in (asks, others))
            i, j = np.nonzero(_sizes_allow(n, m, s) & (similarity(x[:, : s.tokens], y[:, : s.tokens]) >= s.estimate))
            step = 1 << 14
            reach = [may_reach(x[i[k : k + step], s.tokens :], y[j[k : k + step], s.tokens :], n[i[k : k + step]], m[j[k : k + step]], s) for k in range(0, len(i), step)]
            found = [(p, q) for p, q, r in zip(i, j, np.concatenate(reach) if reach else ()) if r and asks[p][1] != others[q][1]]
            a += [asks[p][0] for p, _ in found]
            b += [others[q][0] for _, q in found]
            if len(a) > 10_000:
                yield _pairs(a, b)
                a, b = [], []
        yield _pairs(a, b)

    return meeting.repartition(*_AT).sortWithinPartitions(*_AT).mapInArrow(compare, "a binary, b binary")


# Buckets a hash of the filters on what is fetched, the most they have (16 MB of bits), and those of a piece.
_SPARSE, _MOST, _PIECE = 32, 1 << 27, 1 << 15


def among(rows: DataFrame, hashed: Column, wanted: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Of `rows`, those whose 64-bit hash may be one of `wanted` (hash), with all that are, and the rest; both unshuffled.

    A filter with a bit a bucket grows with `wanted`, so that one in 32 of the others passes or
    fewer; beyond 2^27 buckets more of them pass, and none is lost.
    """
    count = wanted.count()
    buckets = min(_MOST, max(s.buckets, 1 << (_SPARSE * max(1, count) - 1).bit_length()))
    bucket, piece = F.pmod(hashed, F.lit(buckets)), min(_PIECE, buckets)
    bits = wanted.select(F.pmod("hash", F.lit(buckets)).alias("_bucket")).groupBy(F.floor(F.col("_bucket") / piece).alias("_piece"))
    bits = bits.agg(F.bitmap_construct_agg(F.col("_bucket") % piece).alias("_bits"))
    told = rows.withColumn("_bucket", bucket).withColumn("_piece", F.floor(F.col("_bucket") / piece)).join(F.broadcast(bits), "_piece", "left")
    place = (F.col("_bucket") % piece).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    passes = F.col("_bits").isNotNull() & (F.getbit(byte, place % 8) == 1)
    return tuple(told.filter(p).select(*rows.columns) for p in (passes, ~passes))


def _first_texts(docs: DataFrame, nodes: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """cls, text: the texts of the classes' first documents.

    Before texts are shuffled, a filter that grows with the classes leaves most others
    out; texts meet their class and drop their repeats in one shuffle.
    """
    # In a struct, nulls are equal.
    at = F.struct("doc_id", "mark")
    wanted = staged(classes.join(nodes.select("cls", "first.doc_id", "first.mark"), "cls"), "near-wanted")
    near = among(_texts(docs), F.xxhash64("doc_id", "mark"), wanted.select(F.xxhash64("doc_id", "mark").alias("hash")), s)[0]
    # By the key of `wanted`, by which the join has dealt its rows already.
    wanted = wanted.select(at.alias("of"), "cls")
    found = near.select(at.alias("at"), "text").join(wanted, F.col("at") == F.col("of"))
    return staged(found.dropDuplicates(["of", "cls"]).select("cls", "text"), "near-texts")


def resigned(docs: DataFrame, nodes: DataFrame, owing: DataFrame, s: Settings, turn: int) -> DataFrame:
    """cls, lost, path_high, path_low: tokens of further trees for the rows of `owing` (cls, lost)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(s.words)
        for batch in batches:
            chosen = [signature(shingler(text), s.tokens, turn) for text in batch.column("text").to_pylist()]
            high, low = ([part.astype(np.uint8).tobytes() for part in parts] for parts in ([c >> 8 for c in chosen], chosen))
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(high, pa.binary()), pa.array(low, pa.binary())], ["cls", "path_high", "path_low"])

    texts = _first_texts(docs, nodes, owing.select("cls"), s)
    return owing.join(texts.mapInArrow(sign, "cls binary, path_high binary, path_low binary"), "cls")


def confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    texts = _first_texts(docs, nodes, pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), s)
    both = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(s.words)
        for batch in batches:
            keep, known = [], {}

            def shingles(cls: bytes, text: str) -> np.ndarray:
                if cls not in known:
                    if len(known) > 2000:
                        known.clear()
                    known[cls] = shingler(text)
                return known[cls]

            for i, (a, b, text_a, text_b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")))):
                x, y = shingles(a, text_a), shingles(b, text_b)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= s.percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(keep, pa.int64())), batch.column("b").take(pa.array(keep, pa.int64()))], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(confirm, "a binary, b binary")


def near_components(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept, mark (of the text).

    Documents are linked if their sets of shingles have a Jaccard similarity of
    `percent` or more; component_id is the smallest doc_id reachable.  A document
    with fewer words than a shingle has its whole sequence as one; one without words
    has an empty set and no link.

    Equal sets are one class from the start.  A first round links most of what is
    similar; the second looks, in all trees, for links between different components,
    so that a large group of near copies never meets itself pair by pair.  Candidates
    of both are confirmed on full sets.  A pair at the threshold is missed by a tree
    of depth d with probability 1 - 0.8^d: by 12 trees 5e-6 at depth 2, 2e-4 at depth 3, 11% at
    depth 8.  Rows whose trees went so deep that they miss more than `miss` go through 12
    further trees, with new tokens, until the rate holds: at most 48 trees at depth 8.

    Rows that repeat a doc_id with different texts are linked each by their own text.
    A null doc_id is never the smallest unless all are null; `kept` says that doc_id
    is component_id.  An empty table gives an empty result.
    """
    s = settings or Settings()
    with small_batches(docs.sparkSession):
        rows, nodes, labels = _labelled(docs, s)
    full = rows.filter("cls IS NOT NULL")
    owned = nodes.select("cls", F.col("first.doc_id").alias("least")).join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = owned.groupBy("component").agg(F.min("least").alias("component_id"))
    ends = owned.join(least, "component").select("cls", "component_id")
    linked = full.join(ends, "cls").select("doc_id", "n", "component_id", "mark")
    alone = rows.filter("cls IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"), "mark")
    return linked.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "mark")


def _labelled(docs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sketched rows, their classes, and node and component of the classes with links; all of them staged."""
    rows = staged(sketched(docs, s), "near-rows")
    full = rows.filter("cls IS NOT NULL")
    nodes = full.groupBy("cls").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")).alias("first"), *(F.any_value(c).alias(c) for c in ("high", "low", "histogram")), F.max("n").alias("n"))
    nodes = staged(nodes, "near-classes")
    links = staged(confirmed(docs, nodes, staged(first_pairs(nodes, s), "near-pairs"), s), "near-links")
    labels = staged(components(links), "near-labels")
    turn, further = 0, None
    while True:
        pairs, owing = path_pairs(nodes, labels, s, further)
        links = staged(confirmed(docs, nodes, pairs, s), "near-links")
        if not links.isEmpty():
            # What was linked before are stars by now.
            labels = staged(components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links)), "near-labels")
        if owing.isEmpty():
            break
        turn += 1
        further = staged(resigned(docs, nodes, owing, s, turn), "near-further")
    return rows, nodes, labels


@keeping_columns("doc_id", "text")
def without_near_copies(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows of `docs` that stay, one of each component, with all their columns; of rows that repeat a doc_id and text, one stays.

    Rows without words have no copies and stay; a null doc_id stays only where all of its
    component are null; an empty table stays empty.
    """
    told = near_components(docs, settings).select("doc_id", F.col("mark").alias("_text_mark"), "kept")
    rows = docs.withColumn("_text_mark", F.xxhash64(F.col("text").cast("string")))
    return staying(rows, told, ["doc_id", "_text_mark"]).drop("_text_mark")
