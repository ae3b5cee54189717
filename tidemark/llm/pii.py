"""Personal data: patterns, and terms that reveal what the patterns protect."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
# Of the filter on terms: bits of 512 pieces of 4 KB, whatever the number of terms.
BUCKETS, PIECE = 1 << 24, 1 << 15
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
DIAL = re.compile(r"[\x20().0-9-]+")
TERM = re.compile(r"[^\W_]+")
Span = tuple[int, int, str]


def emails(text: str) -> Iterator[Span]:
    """A name is the run of its characters before an @; what follows must be a domain."""
    least, at = 0, text.find("@")
    while at >= 0:
        start = least + len(text[least:at].rstrip(LOCAL))
        least = at + 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            least = domain.end()
            yield start, least, "email"
        at = text.find("@", least)


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def numbers(text: str) -> Iterator[Span]:
    """Addresses and cards are chains of digit runs, joined by single points, or by single spaces or hyphens."""
    runs = [m.span() for m in DIGITS.finditer(text)]
    i = 0
    while i + 3 < len(runs):
        four = runs[i : i + 4]
        if all(text[a[1] : b[0]] == "." for a, b in zip(four, four[1:])):
            if all(e - s <= 3 and int(text[s:e]) <= 255 or int(text[s:e].lstrip("0")[:4] or 0) <= 255 for s, e in four):
                yield four[0][0], four[3][1], "ip"
            i += 4
        else:
            i += 1
    i = 0
    while i < len(runs):
        first, count = i, runs[i][1] - runs[i][0]
        while i + 1 < len(runs) and text[runs[i][1] : runs[i + 1][0]] in (" ", "-"):
            i += 1
            count += runs[i][1] - runs[i][0]
        if 12 <= count <= 19 and luhn("".join(text[s:e] for s, e in runs[first : i + 1])):
            yield runs[first][0], runs[i][1], "card"
        i += 1


def phones(text: str) -> Iterator[Span]:
    at = text.find("+")
    while at >= 0:
        after = at + 1
        if text[after : after + 1] in tuple("0123456789") and (run := DIAL.match(text, after + 1)):
            end = after + 1 + len(run[0].rstrip(" ().-"))
            if end >= after + 3:
                digits = sum(map(str.isdigit, text[at:end]))
                if 9 <= digits <= 15:
                    yield at, end, "phone"
                after = end
        at = text.find("+", after)


def base_spans(text: str) -> list[Span]:
    """All pattern spans, by start, then kind as listed."""
    found = list(emails(text))
    if DIGITS.search(text):
        found += [*numbers(text), *phones(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def entity(text: str, span: Span) -> str:
    """What a span names, the same for different spellings."""
    value = text[span[0] : span[1]]
    return f"{span[2]}:{value.lower() if span[2] == 'email' else ''.join(DIGITS.findall(value)) if span[2] != 'ip' else value}"


def words_outside(text: str, spans: list[Span]) -> Iterator[tuple[int, int, str]]:
    """Start, end and lower-case form of the words that touch no span; spans are in order of their starts."""
    at, covered = 0, 0
    for m in TERM.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            covered = max(covered, spans[at][1])
            at += 1
        if covered <= m.start():
            yield m.start(), m.end(), m[0].lower()


SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])


def _spans(rows: list[dict]) -> list[Span]:
    return [(s["start"], s["end"], s["kind"]) for s in rows]


def scanned(docs: DataFrame) -> DataFrame:
    """uid, doc_id, base (pattern spans), entities (distinct), text (null without spans), one row per row of `docs`."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, entities, texts = [], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                base.append([{"start": s, "end": e, "kind": k} for s, e, k in spans])
                entities.append(sorted({entity(text, s) for s in spans}))
                texts.append(text if spans else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("doc_id"), pa.array(base, pa.list_(SPAN)), pa.array(entities, pa.list_(pa.string())), pa.array(texts, pa.string())],
                ["uid", "doc_id", "base", "entities", "text"],
            )

    rows = docs.select("uid", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, "uid long, doc_id long, base array<struct<start:int,end:int,kind:string>>, entities array<string>, text string")


def terms_of(text: str) -> set[str]:
    """The distinct terms of a text: what is counted for the corpus, for an entity, and marked, is cut alike."""
    return set(map(str.lower, TERM.findall(text)))


def bucket_of(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def wanted_buckets(terms: DataFrame) -> bytes:
    """Which of the buckets hold a term of `terms`, a bit each; tasks gather the bits."""
    bucket = F.crc32(F.encode("term", "UTF-8")).bitwiseAND(BUCKETS - 1).alias("bucket")
    pieces = terms.select(bucket).groupBy(F.shiftright("bucket", PIECE.bit_length() - 1).alias("piece"))
    table = bytearray(BUCKETS // 8)
    for r in pieces.agg(F.bitmap_construct_agg(F.col("bucket").bitwiseAND(PIECE - 1)).alias("bits")).collect():
        table[r["piece"] * PIECE // 8 : (r["piece"] + 1) * PIECE // 8] = r["bits"]
    return bytes(table)


def is_wanted(term: str, wanted: bytes) -> bool:
    """Whether the term's bucket is among `wanted`: always for a wanted term, seldom for any other."""
    bucket = bucket_of(term)
    return bool(wanted[bucket >> 3] >> (bucket & 7) & 1)


PAIRS = "uid long, entity string, term string, mark long"


def _pairs(common: DataFrame, wanted: bytes | None = None) -> DataFrame:
    """uid, entity, term, mark (of the text), once per document, from rows of uid, entities, base and text; of terms in `wanted` buckets only."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds)], ["uid", "entity", "term", "mark"])

        held: list[list] = [[], [], [], []]
        for batch in batches:
            for uid, entities, base, mark, text in zip(*(batch.column(c).to_pylist() for c in ("uid", "entities", "base", "mark", "text"))):
                terms = sorted({w for _, _, w in words_outside(text, _spans(base))})
                if wanted is not None:
                    terms = [w for w in terms if is_wanted(w, wanted)]
                for name in entities:
                    held[0] += [uid] * len(terms)
                    held[1] += [name] * len(terms)
                    held[2] += terms
                    held[3] += [mark] * len(terms)
                    if len(held[0]) > 1 << 16:
                        yield flush()
                        held = [[], [], [], []]
        yield flush()

    return common.select("uid", "entities", "base", F.xxhash64("text").alias("mark"), "text").mapInArrow(pair, PAIRS)


def _document_frequencies(docs: DataFrame, wanted: bytes, most: int = 1 << 17) -> DataFrame:
    """term, df_term over all documents, of terms in `wanted` buckets; combined per task before the shuffle, some `most` terms at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            counts = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])
            seen.clear()
            return counts

        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    seen.update(w for w in terms_of(text) if is_wanted(w, wanted))
                if len(seen) >= most:
                    yield flush()
        yield flush()

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "term string, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("df_term"))


def _marked(told: DataFrame) -> DataFrame:
    """uid, added: where the terms of `revealing` (name and kind) stand in text, outside the pattern spans."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = []
            for base, revealing, text in zip(*(batch.column(c).to_pylist() for c in ("base", "revealing", "text"))):
                kinds = {r["term"]: r["kind"] for r in sorted(revealing, key=lambda r: r["kind"], reverse=True)}
                added.append([{"start": s, "end": e, "kind": kinds[w]} for s, e, w in words_outside(text, _spans(base)) if w in kinds])
            yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(added, pa.list_(SPAN))], ["uid", "added"])

    return told.select("uid", "base", "revealing", "text").mapInArrow(mark, "uid long, added array<struct<start:int,end:int,kind:string>>")


def with_entities(found: DataFrame, least_contexts: int) -> tuple[DataFrame, DataFrame]:
    """(rows with the entities that stand in so many documents; these entities with df_entity)."""
    entities = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("df_entity"))
    entities = staged(entities.filter(F.col("df_entity") >= least_contexts), "pii-entities")
    named = found.select("uid", F.explode("entities").alias("entity")).join(entities, "entity").groupBy("uid").agg(F.collect_list("entity").alias("entities"))
    return staged(found.filter(F.size("entities") > 0).drop("entities").join(named, "uid"), "pii-common"), entities


def disclosing(common: DataFrame, entities: DataFrame, docs: DataFrame, least_contexts: int, threshold: float, doubt: float = 0.01) -> DataFrame:
    """entity, term, share: the terms that reveal an entity.

    share is PMI(term; entity) / IC(entity), 1 for a term that occurs with the entity
    alone: PMI = ln(N joint / (df(term) df(entity))), IC = ln(N / df(entity)), all
    counted over all documents; joint counts the documents with both, wherever they
    stand.  Only pairs seen in `least_contexts` different texts are estimated, so
    that copies of one text prove nothing; entities of fewer documents have no such pair.

    A rare term stands with a frequent entity by chance.  By Chernoff's bound, a term
    of df documents has a share p of them with an entity of the corpus's share q with a chance of at most
    exp(-df KL(p, q)); that bound, times the number of pairs looked at, must be at most `doubt`:
    then fewer than that many terms are expected to be marked by chance in the whole corpus.
    """
    by_text = _pairs(common).groupBy("entity", "term", "mark").agg(F.count(F.lit(1)).alias("n"))
    pairs = by_text.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("contexts"), F.sum("n").alias("joint"))
    candidates = staged(pairs.filter(F.col("contexts") >= least_contexts), "pii-pairs")
    terms = _document_frequencies(docs, wanted_buckets(candidates))
    total = docs.agg(F.count(F.lit(1)).alias("total")).first()["total"]
    looked = max(candidates.count(), 1)
    joint, df_term, n = F.col("joint").cast("double"), F.col("df_term").cast("double"), float(max(total, 1))
    p, q = joint / df_term, F.col("df_entity") / F.lit(n)
    information = -F.log(q)
    pmi = F.log(p / q)
    others = F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - q))).otherwise(0.0)
    proof = df_term * (p * pmi + others)
    estimated = candidates.join(entities, "entity").join(terms, "term")
    share = F.when((information > 0) & (pmi > 0) & (proof >= F.lit(math.log(looked / doubt))), pmi / information).otherwise(0.0)
    return estimated.select("entity", "term", share.alias("share")).filter(F.col("share") >= threshold)


def with_spans(docs: DataFrame, least_contexts: int = 3, threshold: float = 0.75, remove: float = 0.9, text: bool = False) -> DataFrame:
    """Per row: doc_id, base and spans (arrays of start, end, kind; code points, end exclusive), by start, then kind.

    `spans` holds the pattern spans of `base` and the terms that disclose an entity of
    the same document, wherever they stand in it: kind `term`, to be generalised, or `name`, to be
    removed, where the share reaches `remove`.  With `text`, also text and sanitised.

    A null text is empty and has no spans.  Rows that repeat a doc_id or text are
    searched each.  Other columns are ignored.
    """
    numbered = docs.select("doc_id", "text").withColumn("uid", F.monotonically_increasing_id())
    if text:
        numbered = staged(numbered, "pii-texts")
    found = staged(scanned(numbered), "pii")
    common, entities = with_entities(found, least_contexts)
    revealing = staged(disclosing(common, entities, docs, least_contexts, threshold), "pii-terms")
    # Each document brings its own terms, so what is joined grows with the text, however hot an entity.
    own = _pairs(common, wanted_buckets(revealing)).join(revealing, ["entity", "term"])
    worst = own.groupBy("uid", "term").agg(F.max("share").alias("share"))
    kind = F.when(F.col("share") >= remove, "name").otherwise("term").alias("kind")
    told = worst.groupBy("uid").agg(F.collect_list(F.struct("term", kind)).alias("revealing"))
    added = _marked(common.join(told, "uid"))
    order = "CASE {0}.kind WHEN 'email' THEN 0 WHEN 'ip' THEN 1 WHEN 'card' THEN 2 WHEN 'phone' THEN 3 WHEN 'name' THEN 4 ELSE 5 END"
    by = f"array_sort(everything, (a, b) -> CASE WHEN a.start <> b.start THEN a.start - b.start ELSE {order.format('a')} - {order.format('b')} END)"
    everything = F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,end:int,kind:string>>")))
    joined = found.drop("entities", "text").join(added, "uid", "left").withColumn("everything", everything).withColumn("spans", F.expr(by))
    if not text:
        return joined.select("doc_id", "base", "spans")
    hide = F.pandas_udf(_hidden, "string")
    return joined.join(numbered.select("uid", "text"), "uid").select("doc_id", "base", "spans", "text", hide("text", F.to_json("spans")).alias("sanitised"))


def _hidden(texts: pd.Series, spans: pd.Series) -> pd.Series:
    import json

    return pd.Series([sanitise(t, [(s["start"], s["end"], s["kind"]) for s in json.loads(j)]) for t, j in zip(texts, spans)], dtype=object)


def sanitise(text: str | None, spans: list[Span]) -> str | None:
    """The text with pattern spans as [KIND], terms as [TERM] and names taken out; overlapping spans count as the first of them."""
    if text is None:
        return None
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], "" if kind == "name" else f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (as text)."""
    said = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(said("base"), 256).alias("base_sha256"), said("spans").alias("spans"))
