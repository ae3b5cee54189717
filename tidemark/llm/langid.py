"""Language identification by interpolated Kneser-Ney models over characters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import staged

ORDER = 4
# A gram is its characters' code points modulo 2^16 in one 64-bit number, the first character highest.
BITS = 16


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of each text, one per character, and where each text's begin.

    Texts are lower-cased; whatever is no letter is a space, runs are one space; each
    text starts and ends with a space and is preceded by spaces, so that every
    character has a full context.
    """
    joined = ("\0" * ORDER).join(f" {t.lower()} " for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
    letters = _letters()
    codes = np.where(codes == 0, 0, np.where(letters[np.minimum(codes, len(letters) - 1)], codes, 32))
    keep = np.ones(len(codes), bool)
    keep[1:] = ~((codes[1:] == 32) & (codes[:-1] == 32))
    codes = codes[keep]
    # Between texts the zeros are context only: as spaces they start the next text.
    begins = np.concatenate([[0], np.flatnonzero((codes[1:] != 0) & (codes[:-1] == 0)) + 1]) if len(codes) else np.zeros(0, np.int64)
    small = np.where(codes == 0, 32, codes).astype(np.uint64) & np.uint64((1 << BITS) - 1)
    padded = np.concatenate([np.full(ORDER - 1, 32, np.uint64), small])
    found = np.zeros(len(small), np.uint64)
    for i in range(ORDER):
        found = (found << np.uint64(BITS)) | padded[i : i + len(small)]
    real = codes != 0
    places = np.cumsum(real) - 1
    return found[real], places[begins]


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; the last entry stands for all beyond the table."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x323B0)] + [False]))
    return _LETTERS[0]


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all rows of `docs` (lang, text) with both."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for some in _slices(texts):
                    keys, n = np.unique(grams(some)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _slices(texts: list[str], characters: int = 1 << 21) -> Iterator[list[str]]:
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= characters:
            yield some
            some, size = [], 0
    if some:
        yield some


@dataclass
class Level:
    """Sorted grams of one order with their discounted share, and sorted contexts with the share left for the lower order."""

    grams: np.ndarray
    share: np.ndarray
    contexts: np.ndarray
    left: np.ndarray


@dataclass
class Model:
    """An interpolated Kneser-Ney model in sorted arrays, from the highest order down, over `letters` distinct characters."""

    levels: list[Level]
    letters: int

    def logp(self, keys: np.ndarray) -> np.ndarray:
        """Natural logarithm of p(last character | the others) of each gram."""
        total, weight = np.zeros(len(keys)), np.ones(len(keys))
        for i, level in enumerate(self.levels):
            own = keys & np.uint64((1 << (BITS * (ORDER - i))) - 1) if ORDER - i < 4 else keys
            total += weight * _find(level.grams, level.share, own, 0.0)
            weight = weight * _find(level.contexts, level.left, own >> np.uint64(BITS), 1.0)
        return np.log(total + weight / self.letters)


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def _discount(ones: int, twos: int) -> float:
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def _level(keys: np.ndarray, counts: np.ndarray, discount: float | None = None) -> Level:
    """Discount by D = n1 / (n1 + 2 n2) of all grams of the order; keys are sorted, hence contexts are too."""
    if discount is None:
        discount = _discount(int((counts == 1).sum()), int((counts == 2).sum()))
    contexts, begin = np.unique(keys >> np.uint64(BITS), return_index=True)
    totals = np.add.reduceat(counts, begin).astype(float)
    kinds = np.diff(np.append(begin, len(keys)))
    share = (counts - discount) / np.repeat(totals, kinds)
    return Level(keys, share, contexts, discount * kinds / totals)


def train(keys: np.ndarray, counts: np.ndarray) -> Model:
    """Raw counts at the highest order; below, how many characters precede a gram."""
    order = np.argsort(keys)
    keys, counts = keys[order].astype(np.uint64), counts[order]
    levels = [_level(keys, counts)]
    for n in range(ORDER - 1, 0, -1):
        keys, counts = np.unique(keys & np.uint64((1 << (BITS * n)) - 1), return_counts=True)
        levels.append(_level(keys, counts))
    return Model(levels, max(2, len(keys)) + 1)


class Models(dict[str, int]):
    """Per language, its distinct characters and one; `shards` has, from the highest order down, broadcasts of a dictionary from language to Level.

    A gram is in the shard of its context, `shard_of`.
    """

    shards: list[list[Broadcast]] = []


# Contexts are dealt by their remainder modulo a prime.
_PRIME = 1_000_003
_PIECES = 16


def shard_of(contexts: np.ndarray, shards: int) -> np.ndarray:
    return contexts % np.uint64(_PRIME) % np.uint64(_PIECES * shards) % np.uint64(shards)


def fit(docs: DataFrame, rows: int = 1 << 21) -> Models:
    """A model per language of `docs` (lang, text), of all grams of all rows.

    Counts, discounts and the counts of preceding characters are groupings; a piece
    of a language's contexts is turned into arrays by one task.  The driver holds
    one shard of about `rows` grams at a time, on its way to a broadcast, and so
    does a task that scores, which reads all shards.
    """
    spark = docs.sparkSession
    table, models, levels = staged(count_grams(docs), "grams"), Models(), []
    for n in range(ORDER, 0, -1):
        if n < ORDER:
            lower = table.select("lang", F.col("gram").bitwiseAND(F.lit((1 << (BITS * n)) - 1)).alias("gram"))
            table = staged(lower.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")), "grams")
        kinds = table.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos"), F.count(F.lit(1)).alias("all")).collect()
        discounts = {r["lang"]: _discount(r["ones"], r["twos"]) for r in kinds}
        shards = max(1, -(-sum(r["all"] for r in kinds) // rows))
        levels.append(_shards(spark, table, discounts, shards))
    models.update({r["lang"]: max(2, r["all"]) + 1 for r in kinds})
    models.shards = levels
    return models


def _shards(spark: SparkSession, table: DataFrame, discounts: dict[str, float], shards: int) -> list[Broadcast]:
    def arrays(key: tuple, part: pa.Table) -> pa.Table:
        keys, counts = (part.column(c).to_numpy() for c in ("gram", "n"))
        order = np.argsort(keys.view(np.uint64))
        level = _level(keys.view(np.uint64)[order], counts[order], discounts[key[1].as_py()])
        blobs = [pa.array([a.tobytes()], pa.binary()) for a in (level.grams, level.share, level.contexts, level.left)]
        return pa.table([pa.array([key[0].as_py() % shards], pa.int32()), pa.array([key[1].as_py()]), *blobs], ["shard", "lang", "grams", "share", "contexts", "left"])

    context = F.shiftrightunsigned("gram", BITS)
    piece = (context % _PRIME % (_PIECES * shards)).cast("int").alias("piece")
    found = table.select(piece, "lang", "gram", "n").groupBy("piece", "lang").applyInArrow(arrays, "shard int, lang string, grams binary, share binary, contexts binary, left binary")
    found = staged(found, "language-shards")
    held = []
    for i in range(shards):
        parts: dict[str, list] = {}
        for r in found.filter(F.col("shard") == i).collect():
            parts.setdefault(r["lang"], []).append(r)
        held.append(spark.sparkContext.broadcast({lang: _joined(some) for lang, some in parts.items()}))
    return held


def _joined(parts: list) -> Level:
    columns = {c: np.concatenate([np.frombuffer(r[c], np.uint64 if c in ("grams", "contexts") else float) for r in parts]) for c in ("grams", "share", "contexts", "left")}
    grams, contexts = np.argsort(columns["grams"]), np.argsort(columns["contexts"])
    return Level(columns["grams"][grams], columns["share"][grams], columns["contexts"][contexts], columns["left"][contexts])


def _opened(shard: Broadcast, stays: bool) -> dict[str, Level]:
    """The shard's arrays, in a task; unless it stays, they are read anew each time."""
    return shard.value if stays or getattr(shard, "_path", None) is None else shard.load_from_path(shard._path)


def score_texts(names: list[str], letters: np.ndarray, shards: list[list[Broadcast]], texts: list[str]) -> np.ndarray:
    """Cross-entropy of each text (rows) under each language's model (columns), in nats a character."""
    keys, begins = grams(texts)
    kinds, inverse = np.unique(keys, return_inverse=True)
    lengths = np.diff(np.append(begins, len(keys)))
    total, weight = np.zeros((len(names), len(kinds))), np.ones((len(names), len(kinds)))
    for i, level in enumerate(shards):
        own = kinds & np.uint64((1 << (BITS * (ORDER - i))) - 1) if i else kinds
        contexts = own >> np.uint64(BITS)
        at = shard_of(contexts, len(level))
        for j, shard in enumerate(level):
            pick = np.flatnonzero(at == j) if len(level) > 1 else slice(None)
            known = _opened(shard, len(level) == 1)
            for k, name in enumerate(names):
                if name in known:
                    part = known[name]
                    total[k, pick] += weight[k, pick] * _find(part.grams, part.share, own[pick], 0.0)
                    weight[k, pick] *= _find(part.contexts, part.left, contexts[pick], 1.0)
    logp = np.log(total + weight / letters[:, None])
    return -np.stack([np.add.reduceat(row[inverse], begins) for row in logp], axis=1) / lengths[:, None]


def predicted(docs: DataFrame, models: Models | dict, limits: dict[str, float] | None = None) -> DataFrame:
    """All columns of `docs`, with lang_pred, score, entropy and rejected (columns of these names are replaced).

    The prediction is the model with the lowest cross-entropy per character, ties to
    the first language in order; score, in 0 to 1, is its share in the softmax over the
    languages of minus ten times the cross-entropies.  `und` with score 0, always rejected, if the text is
    null or has no letter, or if there is no model.  `rejected` is also true where the
    cross-entropy passes the language's limit of `limits`.
    """
    names = sorted(models)
    letters_of, shards = np.array([models[k] for k in names], float), getattr(models, "shards", [])
    bound = np.array([(limits or {}).get(k, np.inf) for k in names])
    out = "lang_pred string, score double, entropy double, rejected boolean"

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            texts = series.tolist()
            lang, score, entropy, rejected = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts), [True] * len(texts)
            letters = [i for i, t in enumerate(texts) if t and names and any(map(str.isalpha, t))]
            at = 0
            for some in _slices([texts[i] for i in letters]):
                cross = score_texts(names, letters_of, shards, some)
                best = cross.argmin(axis=1)
                soft = np.exp(-10 * (cross - cross.min(axis=1, keepdims=True)))
                share = soft.max(axis=1) / soft.sum(axis=1)
                for k, b in enumerate(best):
                    i = letters[at + k]
                    lang[i], score[i], entropy[i], rejected[i] = names[b], float(share[k]), float(cross[k, b]), bool(cross[k, b] > bound[b])
                at += len(some)
            yield pd.DataFrame({"lang_pred": lang, "score": score, "entropy": pd.array(entropy, dtype="Float64"), "rejected": rejected})

    label = F.pandas_udf(predict, out)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "entropy", "rejected")]
    return docs.withColumn("_said", label(F.col("text").cast("string"))).select(*kept, "_said.*")


def limits_of(said: DataFrame, quantile: float = 0.999, margin: float = 1.5, least: int = 20) -> dict[str, float]:
    """Per language, the cross-entropy beyond which a text is rejected: `margin` times the `quantile` over its distinct labelled texts that get their own label.

    `said` is labelled rows with lang, text_mark (a hash of the text), lang_pred and
    entropy, all of which count.  A language with fewer than `least` such texts tells
    little of its own: its limit is no lower than the highest of those with more.
    """
    texts = said.filter("lang_pred = lang").groupBy("lang", "text_mark").agg(F.first("entropy").alias("entropy"))
    table = texts.groupBy("lang").agg(F.percentile_approx("entropy", quantile, 10000).alias("limit"), F.count(F.lit(1)).alias("n")).collect()
    found = {r["lang"]: float(r["limit"]) * margin for r in table}
    known = max((found[r["lang"]] for r in table if r["n"] >= least), default=0.0)
    return found | {r["lang"]: max(found[r["lang"]], known) for r in table if r["n"] < least}


def calibrate(docs: DataFrame, models: Models | dict, quantile: float = 0.999, margin: float = 1.5) -> dict[str, float]:
    """The limits of `limits_of` over all labelled rows of `docs` (lang, text)."""
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    return limits_of(marked(predicted(rows, models)), quantile, margin)


def marked(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_mark", F.xxhash64(F.col("text").cast("string")))


def beyond(said: DataFrame, limits: dict[str, float]) -> DataFrame:
    """`said`, predicted without limits, with `rejected` by `limits`."""
    if not limits:
        return said
    limit = F.create_map(*(F.lit(x) for pair in limits.items() for x in pair))
    return said.withColumn("rejected", F.col("rejected") | F.coalesce(F.col("entropy") > F.try_element_at(limit, F.col("lang_pred")), F.lit(False)))
