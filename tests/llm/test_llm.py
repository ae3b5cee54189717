"""The training-data operators against brute force, on small fixtures with awkward rows."""

import base64
import hashlib
import importlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, exact, langid, mix, near, pack, pii, tokenbin, tokens, warc, wrapper
from tidemark.llm.components import components
from tidemark.plans.staging import new_path

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")

BASE = " ".join(f"word{i}" for i in range(60))
DOCS = [
    (5, BASE, "a"),
    (3, BASE.replace("word7 ", "other "), "a"),
    (9, BASE.replace(" ", "  \n"), "b"),
    (1, "", "b"),
    (2, None, None),
    (4, "one", "c"),
    (6, "one", None),
    (7, " \t one two  <|endoftext|> x\x1c y it's  \n\n don't. ", "c"),
    (8, "lone wolf " * 1500, "a"),
    (8, "lone wolf " * 1500, "a"),
    (None, "nobody knows this row of words", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    # Columns named like the operators' own must not disturb them.
    return spark.createDataFrame([(*d, 1, "x") for d in DOCS], "doc_id long, text string, source string, rank int, _n string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    texts = [d[1] or "" for d in DOCS] + ["a_b_ c__ x²! ́z. <|endoftext|>!", "  lead  \r\n trail  ", "12,3 ..!! éü中文."]
    for words in (4, 500_000):
        found = tokens.Encoder(PATH, words=words)(texts)
        assert found == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    data = tokenbin.encode_file(2, 1, bits, 64, [7, None, 9], [ids[:10], ids[10:10], ids[10:]])
    file = tokenbin.TokenFile(data)
    assert file.doc_ids == [7, None, 9] and list(file.counts) == [10, 0, 991]
    for start, stop in ((0, 1001), (63, 65), (500, 700), (1000, 1001)):
        assert (file.ids(start, stop) == ids[start:stop]).all()


def encoded(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_token_files(spark, docs, empty):
    found = sorted(tuple(r) for r in tokenbin.token_digests(docs.filter("doc_id IS NOT NULL"), new_path(spark, "t"), PATH, 0).collect())
    start, wanted = 0, []
    for doc_id, text, _ in sorted((d for d in DOCS if d[0] is not None), key=lambda d: d[0]):
        ids = np.array([*encoded(text), 0], "<u4")
        wanted.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == sorted(wanted)
    assert tokenbin.token_digests(empty, new_path(spark, "t"), PATH, 0).count() == 0


def test_packing(docs, empty):
    pieces = pack.packed(docs, PATH, window=64).collect()
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
        assert p["length"] * 4 == len(p["ids"])
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == members[0]["sequence_length"] <= 64
    assert sum(m[0]["sequence_length"] < 64 for m in by_sequence.values()) <= 1
    long = sorted((p for p in pieces if p["doc_id"] == 5), key=lambda p: p["start"])
    assert b"".join(bytes(p["ids"]) for p in long) == np.array([*encoded(BASE), 1], "<u4").tobytes()
    assert sum(p["length"] for p in pieces) == sum(len(encoded(d[1])) + 1 for d in DOCS)
    assert pack.packed(empty, PATH).count() == 0


def test_least_squares_covers_a_solvable_histogram():
    histogram = np.zeros(64, np.int64)
    histogram[[10, 54, 20, 44]] = 500, 500, 30, 30
    plan = pack.make_plan(histogram, 64)
    assert plan.rest == [] and plan.full_first == 530


def test_exact(docs, empty):
    wanted = {}
    for doc_id, text, _ in DOCS:
        wanted.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    found = exact.exact_groups(docs).collect()
    for text, ids in wanted.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        rows = [r for r in found if r["text_sha256"] == sha]
        least = min((i for i in ids if i is not None), default=None)
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, ids))
        assert all(r["keep_id"] == least and r["group_size"] == len(ids) and r["kept"] == (r["doc_id"] == least) for r in rows)
    stay = exact.without_copies(docs)
    assert stay.columns == docs.columns and stay.count() == len(wanted)
    assert exact.exact_groups(empty).count() == 0


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


@pytest.mark.parametrize("words", [2, 5])
def test_near(spark, docs, words):
    found = near.near_components(docs.filter("doc_id IS NOT NULL"), near.Settings(words=words)).collect()
    sets = {d[0]: shingles(d[1], words) for d in DOCS if d[0] is not None}
    for r in found:
        linked, before = {r["doc_id"]}, 0
        while len(linked) != before:
            before = len(linked)
            linked |= {b for b in sets for a in linked if jaccard(sets[a], sets[b]) >= 0.8}
        assert r["component_id"] == min(linked) and r["kept"] == (r["doc_id"] == min(linked)) and r["n_shingles"] == len(sets[r["doc_id"]])


def test_near_group_of_many_near_copies(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(300):
        own = list(words)
        for k in rng.choice(300, rng.integers(0, 14), replace=False):
            own[k] = f"x{i}_{k}"
        texts.append(" ".join(own))
    rows = [(i, t) for i, t in enumerate(texts)]
    found = {r["doc_id"]: r["component_id"] for r in near.near_components(spark.createDataFrame(rows, "doc_id long, text string"), near.Settings(words=2, small=16)).collect()}
    sets = [shingles(t, 2) for t in texts]
    top = list(range(300))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(300):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8 and root(i) != root(j):
                low, high = sorted((root(i), root(j)))
                top[high] = low
    assert found == {i: root(i) for i in range(300)}


def test_near_pairs_of_deep_nodes(spark):
    # All share a long passage, so nodes stay crowded down to the last level, where 12 trees miss one in ten.
    shared, texts = " ".join(f"w{i}" for i in range(400)), []
    for i in range(120):
        common = " ".join(f"c{i}_{k}" for k in range(22))
        texts += [" ".join([shared, common, *(f"{side}{i}_{k}" for k in range(48))]) for side in "ab"]
    sets = [shingles(t, 2) for t in texts]
    linked = [i for i in range(0, 240, 2) if jaccard(sets[i], sets[i + 1]) >= 0.8]
    assert len(linked) == 120 and jaccard(sets[0], sets[2]) < 0.8
    found = {r["doc_id"]: r["component_id"] for r in near.near_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), near.Settings(words=2, small=4)).collect()}
    assert [i for i in linked if found[i + 1] != i] == []


def test_histograms_never_turn_down_a_link():
    random, s = np.random.default_rng(3), near.Settings()
    for size, changed in [(1, 0), (5, 0), (40, 4), (300, 30), (300, 33), (40_000, 4_400), (3_000_000, 300_000)]:
        shared = near.mix(random.integers(0, 1 << 63, size, dtype=np.uint64))
        own = [near.mix(random.integers(0, 1 << 63, changed, dtype=np.uint64)) for _ in range(2)]
        for x, y in [(np.concatenate([shared, own[0]]), np.concatenate([shared, own[1]])), (np.concatenate([shared, *own]), shared)]:
            common = len(np.intersect1d(x, y))
            assert 100 * common >= s.percent * (len(np.union1d(x, y)))
            x_bytes, y_bytes = (near.histogram(z)[None] for z in (x, y))
            assert near.may_reach(x_bytes, y_bytes, np.array([len(x)]), np.array([len(y)]), s).all()
    x, y = (near.mix(random.integers(0, 1 << 63, 50, dtype=np.uint64)) for _ in range(2))
    x_bytes, y_bytes = (near.histogram(z)[None] for z in (x, y))
    assert not near.may_reach(x_bytes, y_bytes, np.array([50]), np.array([50]), s).any()


def test_near_empty(empty, docs):
    assert near.near_components(empty).count() == 0
    assert near.without_near_copies(docs).columns == docs.columns


def test_a_path_gives_one_row_to_what_is_compared(spark, monkeypatch):
    """However deep the nodes are that branch on; before, a row came from each of a path's levels."""
    base = [f"w{i}" for i in range(30)]
    texts = [" ".join(w if i % 4 else f"own{k}_{i}" for i, w in enumerate(base)) for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found, meeting = [], near._meeting
    monkeypatch.setattr(near, "_meeting", lambda rows, nodes, s: found.append(rows) or meeting(rows, nodes, s))
    s = near.Settings(words=1, small=4)
    assert near.near_components(docs, s).filter("kept").count() == 40
    assert found[0].count() and all(rows.groupBy("id").count().agg({"count": "max"}).first()[0] in (None, *range(s.trees + 1)) for rows in found)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_first_texts_are_shuffled_once(spark, monkeypatch):
    """By the key they are found by; before, once more by class. Null ids and rows that come twice give a class one text."""
    plans, staged = {}, near.staged
    monkeypatch.setattr(near, "staged", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()) and None or staged(df, name))
    rows = [(1, "a b c"), (1, "a b c"), (None, "d e f"), (None, "d e f"), (2, "g h i"), (1, "other text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    s = near.Settings(words=2)
    nodes = near.sketched(docs, s).groupBy("cls").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
    wanted = nodes.join(near._texts(docs).filter("text <> 'g h i'").select(F.col("mark").alias("of")).distinct(), F.col("first.mark") == F.col("of")).select("cls")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = sorted(r["text"] for r in near._first_texts(docs, nodes, wanted, s).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == ["a b c", "d e f", "other text"]
    assert "SortMergeJoin" in plans["near-texts"] and "hashpartitioning(cls" not in plans["near-texts"] and "hashpartitioning(of#" in plans["near-texts"]
    assert plans["near-texts"].count("Exchange hashpartitioning") == 3


def test_the_filter_grows_with_what_is_wanted(spark):
    """All that is wanted passes and few others, however many are wanted; before, all passed beyond the number of its buckets."""
    rows = spark.range(40_000).select("id", F.when(F.col("id") != 39_999, F.xxhash64("id")).alias("hash"))
    for n in (0, 1, 4000):
        passed, rest = near.among(rows, F.col("hash"), rows.filter(F.col("id") < n).select("hash"), near.Settings(buckets=64))
        ids = {r["id"] for r in passed.collect()}
        assert ids >= set(range(n)) and len(ids) <= n + 40_000 // 24
        assert {r["id"] for r in rest.collect()} == set(range(40_000)) - ids


def test_only_crowded_nodes_are_followed_down(spark):
    s = near.Settings(small=4)
    rows = spark.createDataFrame([(1, 1, 7, b"abcdefghijkl", 4), (2, 2, 8, b"abcdefghijkl", 5)], "id long, component long, node long, left binary, crowd long")
    levels = {}
    for r in near._steps(rows, s).collect():
        levels.setdefault(r["id"], []).append(r["level"])
    assert {k: sorted(v) for k, v in levels.items()} == {1: [2], 2: [2, 3, 4, 5, 6, 7, 8]}


def test_profiles_go_only_to_rows_with_a_partner(spark, monkeypatch):
    """Many share a first node with texts unlike theirs; before, each took its whole profile along."""
    joined, hopeful = [], near._hopeful
    monkeypatch.setattr(near, "_hopeful", lambda meeting, owned, s: joined.append((meeting, hopeful(meeting, owned, s))) or joined[-1][1])
    # A long text's few common words are often the smallest of its trees.
    texts = [" ".join(["same"] * 3 + [f"w{i}_{k}" for k in range(3)]) for i in range(60)]
    texts += [" ".join(f"p{k}" for k in range(50)) + f" end{i}" for i in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = near.near_components(docs, near.Settings(words=1, first_trees=0, trees=12))
    assert found.filter("NOT kept").select("doc_id", "component_id").collect() == [(61, 60)]
    met, kept = joined[0][0].count(), joined[0][1].count()
    assert 0 < kept < met / 3


def test_few_links_take_no_rounds(spark, monkeypatch):
    module = importlib.import_module("tidemark.llm.components")
    tables, staged = [], module.staged
    monkeypatch.setattr(module, "staged", lambda df, name: tables.append(name) or staged(df, name))
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long").repartition(4)
    wanted = {i: 0 for i in range(41)}
    assert {r["node"]: r["component"] for r in components(links).collect()} == wanted and len(tables) == 2
    monkeypatch.setattr(module, "EDGES", 5)
    assert {r["node"]: r["component"] for r in components(links).collect()} == wanted
    assert components(links.limit(0)).count() == 0


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    assert {r["node"]: r["component"] for r in components(links).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_subset_comes_nearest():
    assert (mix.subset(np.array([3, 5]), np.array([4, 4]), 19) * [3, 5]).sum() == 19
    assert (mix.subset(np.array([10]), np.array([3]), 14) * [10]).sum() == 10
    rng = np.random.default_rng(1)
    lengths, counts = np.arange(1, 200), rng.integers(0, 50, 199)
    for budget in (7, 1234, 40_000):
        taken = mix.subset(lengths, counts, budget)
        assert (taken <= counts).all() and (taken * lengths).sum() == budget


def test_mixture(docs, empty):
    found = mix.mixture(docs).collect()
    again = mix.mixture(docs.repartition(3)).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, found)) == sorted(map(key, again)) and len(found) == len(DOCS)
    sizes = {}
    for _, text, source in DOCS:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert all(r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 2 * r["size"] for r in found)
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    goal, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            goal[s] = 2.0 * sizes[s]
            left -= goal[s]
        free -= over
    goal |= {s: level * weight[s] for s in free}
    for r in found:
        assert r["target"] == pytest.approx(goal[r["source"]])
    assert mix.mixture(empty).count() == 0


def test_language(spark):
    rng = np.random.default_rng(5)
    kinds = {"xx": ["blor", "nim", "tak", "oru"], "yy": ["ésh", "qua", "vel", "ñi"]}
    text = lambda k, n: " ".join("".join(rng.choice(kinds[k], 2)) for _ in range(n))
    learn = spark.createDataFrame([(k, text(k, 50)) for k in kinds for _ in range(40)] + [("xx", None), (None, "foo"), ("yy", "")], "lang string, text string")
    models = langid.fit(learn)
    rows = [(i, text(k, 3), k) for i, k in enumerate(["xx", "yy"] * 30)] + [(100, None, "und"), (101, "12 +!", "und"), (102, "", "und")]
    said = langid.predicted(spark.createDataFrame(rows, "doc_id long, text string, score string"), models, langid.calibrate(learn, models)).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in said} == {r[0]: r[2] for r in rows}
    assert all(0 <= r["score"] <= 1 and r["rejected"] == (r["lang_pred"] == "und") for r in said)
    strange = langid.predicted(spark.createDataFrame([(1, "жщя ыф " * 20)], "doc_id long, text string"), models, langid.calibrate(learn, models)).first()
    assert strange["rejected"]
    assert langid.fit(learn.limit(0)) == {} and langid.predicted(learn, {}).first()["lang_pred"] == "und"


def test_language_models_keep_every_gram(spark):
    rng = np.random.default_rng(8)
    text = lambda first, n: "".join(chr(c) for c in rng.integers(first, first + 40, n))
    rows = [(lang, text(first, 900)) for lang, first in (("xx", 0x4E00), ("yy", 0x4E10)) for _ in range(12)]
    # Many shards, each of few grams: the model is the one of all grams in memory.
    models = langid.fit(spark.createDataFrame(rows, "lang string, text string"), rows=1 << 12)
    assert len(models.shards[0]) > 3
    whole = {lang: langid.train(*np.unique(langid.grams([t for k, t in rows if k == lang])[0], return_counts=True)) for lang in ("xx", "yy")}
    assert models == {lang: m.letters for lang, m in whole.items()}
    asked = [text(0x4E08, 60) for _ in range(40)]
    said = langid.predicted(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), models).collect()
    for r in said:
        keys = langid.grams([asked[r["doc_id"]]])[0]
        cross = {lang: -m.logp(keys).mean() for lang, m in whole.items()}
        assert r["entropy"] == pytest.approx(min(cross.values())) and r["lang_pred"] == min(cross, key=cross.get)


def test_rejection_limits_count_every_language_and_each_text_once(spark):
    rows = [("xx", i % 500, "xx", 1.0 + (i % 500) / 1000) for i in range(60_000)] + [("xx", 1000, "xx", 0.1)] * 30_000
    rows += [("yy", 2000 + i, "yy", 0.5) for i in range(2)] + [("zz", 3000, "xx", 9.0)]
    said = spark.createDataFrame(rows, "lang string, text_mark long, lang_pred string, entropy double")
    limits = langid.limits_of(said, quantile=0.5)
    assert limits["xx"] == pytest.approx(1.5 * 1.249, abs=0.01) and limits["yy"] == limits["xx"]
    few = spark.createDataFrame([(1, "yy", 0.9, False), (2, "yy", 5.0, False), (3, "und", None, True)], "doc_id long, lang_pred string, entropy double, rejected boolean")
    assert {r["doc_id"]: r["rejected"] for r in langid.beyond(few, limits).collect()} == {1: False, 2: True, 3: True}


def test_a_language_of_few_rows_gets_a_limit(spark):
    rng = np.random.default_rng(5)
    text = lambda kinds, n: " ".join("".join(rng.choice(kinds, 2)) for _ in range(n))
    rows = [("xx", text(["blor", "nim", "tak", "oru"], 4)) for _ in range(30_000)] + [("yy", text(["ésh", "qua", "vel", "ñi"], 50)) for _ in range(1)]
    learn = spark.createDataFrame(rows, "lang string, text string")
    assert set(langid.calibrate(learn, langid.fit(learn))) == {"xx", "yy"}


def test_kneser_ney_sums_to_one():
    keys, counts = np.unique(langid.grams(["abc abd aab", "cab"])[0], return_counts=True)
    model = langid.train(keys, counts)
    letters = [ord(c) for c in "abcd "]
    for context in ("  a", " ab", "dab", "ddd"):
        high = 0
        for c in context:
            high = (high << 16) | ord(c)
        p = np.exp(model.logp(np.array([(high << 16) | x for x in letters], np.uint64)))
        assert 0.5 < p.sum() <= 1 + 1e-9


def test_pattern_spans():
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind, s):
        digits = re.sub("[^0-9]", "", s)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in s.split(".")), "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]

    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("a1@.+ -()2590%"), 40)) for _ in range(3000)]
    texts += ["4041894974608795 4041-8949-7460-8795 +1 (988) 555-2485 1.2.3.4.5.6.7.8 256.1.1.1 a@@b.c x@y.z@w.v 000.001.2.0255", "+12", "@" * 50, "9" * 2000]
    for text in texts:
        wanted = sorted((m.start(), list(patterns).index(k), m.end()) for k, p in patterns.items() for m in re.finditer(p, text) if good(k, m[0]))
        assert [(s, pii.KINDS.index(k), e) for s, e, k in pii.base_spans(text)] == wanted, text


def test_disclosing_terms(spark):
    words = "alpha bravo charlie delta echo foxtrot golf hotel india juliet".split()
    rng = np.random.default_rng(4)
    filler = lambda: " ".join(rng.choice(words, 12))
    rows = [(i, f"{filler()} Zorbax wrote boss@corp.example {filler()}") for i in range(6)] + [(i, filler()) for i in range(6, 60)] + [(60, None), (61, "")]
    found = {r["doc_id"]: r for r in pii.with_spans(spark.createDataFrame(rows, "doc_id long, text string"), text=True).collect()}
    assert all(r["base"] == [s for s in r["spans"] if s["kind"] == "email"] for r in found.values())
    for i in range(6):
        assert "Zorbax" not in found[i]["sanitised"] and "[EMAIL]" in found[i]["sanitised"] and "boss" not in found[i]["sanitised"]
    assert all(not found[i]["spans"] for i in range(6, 62)) and found[60]["sanitised"] is None
    # Copies of one passage prove nothing.
    same = spark.createDataFrame([(i, "Zorbax wrote boss@corp.example today") for i in range(9)] + rows[6:], "doc_id long, text string")
    assert pii.digests(pii.with_spans(same)).filter("spans LIKE '%name%' OR spans LIKE '%term%'").count() == 0
    assert pii.with_spans(same.limit(0)).count() == 0


def test_disclosing_terms_far_from_the_pattern(spark):
    rng = np.random.default_rng(4)
    filler = lambda: " ".join(rng.choice("alpha bravo charlie delta echo foxtrot golf hotel india juliet".split(), 60))
    rows = [(i, f"Zorbax Li 4711 {filler()} boss@corp.example {filler()} Zorbax") for i in range(6)] + [(i, filler()) for i in range(6, 60)]
    found = pii.with_spans(spark.createDataFrame(rows, "doc_id long, text string"), text=True).collect()
    assert len(found) == 60 and all(not r["spans"] for r in found if r["doc_id"] >= 6)
    for r in found:
        if r["doc_id"] < 6:
            assert [r["text"][s["start"] : s["end"]] for s in r["spans"]] == ["Zorbax", "Li", "4711", "boss@corp.example", "Zorbax"]
            assert r["sanitised"].count("alpha") == r["text"].count("alpha")


PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">menu {0}</a></ul></nav><!-- <p>no</p> -->'
    '<div class="ad">buy {0}</div><article><header><h1>Head {0}</h1></header><p><b>First &amp; {0}<br>line<p>Second&nbsp;para {0}</p><p>Read more on our site</p>'
    '<div class="comments"><p>reader {0}</div></article><aside>side</aside><form><p>sign up</form><footer>foot {0}</footer>'
)


def test_main_text(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(i)) for i in range(12)]
    rows += [(20, "http://o.example/", "<p>plain <i>words</i> here<div>more</div>"), (21, None, None), (22, "x", ""), (23, "http://o.example/2", "a < b &lt; c <p"), (0, "http://h.example/0", PAGE.format(0))]
    found = wrapper.main_text(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int"))
    text = {r["page_id"]: r["text"] for r in found.collect()}
    assert found.count() == len(rows)
    assert all(text[i] == f"Head {i} First & {i} line Second para {i}" for i in range(12))
    assert text[20] == "plain words here more" and text[21] == "" and text[22] == "" and text[23].startswith("a < b < c")
    assert wrapper.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_templates_of_all_layouts_of_a_host(spark):
    one = "<html><body><div class='top'><p>Our site</p></div><div class='text'><p>story {0}</p></div></body></html>"
    two = "<html><body><table><tr><td>All offers</td></tr></table><section><p>tale {0}</p></section></body></html>"
    # The page with the smallest id is empty.
    rows = [(0, None)] + [(i, (one if i % 2 else two).format(i)) for i in range(1, 31)]
    found = wrapper.main_text(spark.createDataFrame([(i, f"http://l.example/{i}", h) for i, h in rows], "page_id long, url string, html string"))
    assert {r["page_id"]: r["text"] for r in found.collect()} == {0: "", **{i: f"{'story' if i % 2 else 'tale'} {i}" for i in range(1, 31)}}


def test_tree_matching_skips_what_one_side_lacks():
    tree = lambda *nodes: __import__("json").dumps(nodes)
    a = tree([-1, ""], [0, "html"], [1, "div"], [1, "p"])
    b = tree([-1, ""], [0, "html"], [1, "table"], [1, "p"])
    assert wrapper.align(a, b) == [0, 1, -1, 3]


def test_archives(spark):
    rows = [(4, "http://a/x y", "same"), (2, "http://a/2", "same"), (7, None, None), (9, "http://b", ""), (5, "http://c", "WARC/1.1\r\n\r\n\r\nWARC-Type: x é"), (2, "http://a/2", "same")]
    path = new_path(spark, "w")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path, file_bytes=600)
    found = warc.captures(warc.read_records(spark, path))
    said = sorted((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in warc.capture_digests(found).collect())
    sha = lambda s: base64.b32encode(hashlib.sha1((s or "").encode()).digest()).decode()
    wanted = [
        (4, "revisit", 2, 4, sha("same")), (2, "response", None, 4, sha("same")), (2, "response", None, 4, sha("same")), (7, "response", None, 0, sha("")),
        (9, "revisit", 7, 0, sha("")), (5, "response", None, len(rows[4][2].encode()), sha(rows[4][2])),
    ]
    assert said == sorted(wanted)
    page = found.filter("metadata.page_id = 5").first()
    assert bytes(page["response"]["payload"]).decode() == rows[4][2] and page["metadata"]["url"] == "http://c" and page["request"]["text"].startswith("GET http://c HTTP")


def test_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 8))
    x[50:80] = x[50]
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(700, None), (701, [0.0] * 8), (702, [float("nan")] * 8), (703, [None] * 8), (None, [1.0] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    small = ann.Settings(neighbours=12, reverse=8, pivots=8, near_pivots=3, block=100, descents=2, pool=40)
    found = {}
    for r in ann.neighbours(table, "vec_id", "embedding", every=10, settings=small).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["id"], r["distance"])
    hits = 0
    for q in range(0, 600, 10):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        wanted = np.lexsort((np.arange(600), d))[:10]
        assert sorted(found[q]) == list(range(1, 11))
        assert all(abs(dist - d[i]) < 1e-12 for i, dist in found[q].values())
        hits += len(set(wanted) & {i for i, _ in found[q].values()})
    assert hits / 600 >= 0.95 and [found[50][k][0] for k in range(1, 11)] == list(range(51, 61))
    few = ann.neighbours(table.filter("vec_id < 5"), "vec_id", "embedding", every=2).collect()
    assert len(few) == 3 * 4
    assert ann.neighbours(table.limit(0), "vec_id", "embedding", every=2).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(8)
    words = "the of and to in is that it was for on are as with his they at be this from have or by one had not but what all were".split()
    rows = [(i, " ".join(rng.choice(words, 60)), "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(100, rows[0][1], "en", "s0", 0), (101, rows[1][1] + " end", "en", "s1", 0), (102, "12345", None, "s2", 0), (103, None, "en", None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        columns, docs = docs.columns, stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
    assert sorted(r["doc_id"] for r in docs.collect()) == list(range(60))
    assert corpus_pipeline.run(spark, str(tmp_path)).agg(F.sum("length")).first()[0] > 0
