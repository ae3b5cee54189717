"""Main text and personal data against second implementations, and on awkward input."""

import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np

from tidemark.llm import pii, wrapper


def tree_of(nested, out=None, parent=-1):
    """A tree from (label, children…)."""
    out = [] if out is None else out
    at = len(out)
    out.append([parent, nested[0]])
    for child in nested[1:]:
        tree_of(child, out, at)
    return out


def random_tree(rng, depth=0):
    labels = rng.sample("abcdef", rng.randint(0, 4)) if depth < 4 else []
    return ("" if depth == 0 else rng.choice("xyz"), *((label, *random_tree(rng, depth + 1)[1:]) for label in labels))


def best_matching(a, b):
    """Simple tree matching by the textbook: a table over children, recursively."""
    if a[0] != b[0]:
        return 0
    rows, columns = a[1:], b[1:]
    table = [[0] * (len(columns) + 1) for _ in range(len(rows) + 1)]
    for x, row in enumerate(rows, 1):
        for y, column in enumerate(columns, 1):
            table[x][y] = max(table[x - 1][y], table[x][y - 1], table[x - 1][y - 1] + best_matching(row, column))
    return table[-1][-1] + 1


def test_matching_is_the_best_that_keeps_order():
    rng = random.Random(7)
    for _ in range(300):
        a, b = random_tree(rng), random_tree(rng)
        x, y = tree_of(a), tree_of(b)
        found = wrapper.align(x, y)
        assert sum(f >= 0 for f in found) == best_matching(a, b)
        for i, j in enumerate(found):
            if j >= 0:
                assert x[i][1] == y[j][1] and (i == 0 or found[x[i][0]] == y[j][0])
        for i in range(1, len(x)):
            # Matched siblings keep their order.
            later = [k for k in range(i + 1, len(x)) if x[k][0] == x[i][0] and found[k] >= 0]
            assert found[i] < 0 or all(found[k] > found[i] for k in later)


def test_a_grown_template_holds_every_tree():
    rng = random.Random(11)
    for _ in range(60):
        trees = [tree_of(random_tree(rng)) for _ in range(8)]
        template = [[-1, ""]]
        for tree in trees:
            template = wrapper.grown(template, tree)
        assert all(parent < i for i, (parent, _) in enumerate(template))
        for tree in trees:
            found = wrapper.align(tree, template)
            assert -1 not in found and len(set(found)) == len(found)


def pages_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def texts(found):
    return {r["page_id"]: r["text"] for r in found.collect()}


def test_hosts_against_what_was_planted(spark):
    """Templates of several sections around varying content, in hosts of two pages and of many; some pages swap two parts."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows, wanted = [], {}
    for host, count in (("two.example", 2), ("some.example", 7), ("many.example", 300)):
        fixed = [prose(8) for _ in range(4)]
        for n in range(count):
            i = len(rows)
            title, parts = prose(4), [prose(30) for _ in range(rng.randint(1, 5))]
            body = f"<div class='story'><h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in parts) + "</div>"
            side = f"<div class='box one'><p>{fixed[1]}</p></div>"
            middle = body + side if n % 5 or count == 2 else side + body
            rows.append((i, f"https://{host.upper()}/{n}", f"<body><div class='top'><p>{fixed[0]}</p></div>{middle}<table><tr><td>{fixed[2]}<td>{fixed[3]}</table></body>"))
            wanted[i] = " ".join([title, *parts])
    assert texts(wrapper.main_text(pages_frame(spark, rows))) == wanted


def test_articles_are_not_lost_to_names(spark):
    story = "<p>A long enough story, told in one paragraph of its own.</p><p>And another one follows it here.</p>"
    pages = [
        f'<div class="layout no-sidebar"><article>{story}</article></div>',
        f'<div id="page" class="with-header"><article>{story}</article></div>',
        f'<div class="sidebar"><article>{story}</article></div>',
        f'<article><section class="discussion">{story}</section></article>',
        f'<article><div class="entry-header"><h1>Head</h1></div>{story}</article>',
        f'<article><div class="header"><h1>Head</h1></div>{story}</article><div class="header"><p>Site</p></div>',
        f'<nav><p>{"menu " * 3}</p></nav><div class="banner">{story}{story}</div>',
        f'<article>{story}<div class="comments"><p>reader</p></div><div class="x ad y">buy</div></article><aside>side</aside>',
    ]
    found = texts(wrapper.main_text(pages_frame(spark, [(i, f"http://{i}.example/", p) for i, p in enumerate(pages)])))
    told = "A long enough story, told in one paragraph of its own. And another one follows it here."
    assert [found[i] for i in range(8)] == [told, told, told, told, f"Head {told}", f"Head {told}", f"{told} {told}", told]


def test_copies_of_an_article_stay(spark):
    """Pages that are equal, or differ only beside a repeated article, keep it."""
    article = "<article><h1>Same</h1><p>The same long story on each of these pages, word for word.</p></article>"
    rows = [(i, f"http://c.example/{i}", f"<body><p>intro</p>{article}</body>") for i in range(5)]
    rows += [(10 + i, f"http://d.example/{i}", f"<body><div class='x'><p>offer {i}</p></div>{article}</body>") for i in range(5)]
    found = texts(wrapper.main_text(pages_frame(spark, rows)))
    told = "Same The same long story on each of these pages, word for word."
    assert all(found[i] == told for i in (*range(5), *range(10, 15)))


def test_parsing_is_linear():
    hard = ["<a " * 350_000, "<div>" * 100_000 + "</p>" * 100_000, "<a href='" * 100_000, "<a \">" * 200_001, "<" * 1_000_000, "<!--" * 250_000, "<script>" * 100_000, "<p>x" * 200_000, "&" * 500_000]
    for page in hard:
        begin = time.process_time()
        wrapper.parse(page)
        assert time.process_time() - begin < 4, page[:10]
    deep = wrapper.parse("".join(f"<div class='c{i % 3}'>" for i in range(20_000)) + "text")[0]
    assert wrapper.align(deep, deep[:]) == list(range(len(deep))) and len(wrapper.grown([[-1, ""]], deep)) == len(deep)


def test_main_text_of_awkward_pages(spark):
    rows = [(1, None, None), (2, "x", ""), (3, "http://e.example/", "   "), (3, "http://e.example/", "<p>twice</p>"), (None, "http://e.example/n", "<p>no id</p>"), (4, "http://v.example/", "<p>" + "word " * 300_000 + "</p>")]
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "page_id long, url string, html string, tree string, slot int, host string")
    found = wrapper.main_text(frame).collect()
    assert len(found) == 6 and {r["n_chars"] for r in found if r["page_id"] == 4} == {1_499_999}
    assert sorted((r["text"] for r in found if r["page_id"] == 3)) == ["", "twice"] and all(r["text"] == "" for r in found if r["page_id"] in (1, 2))


def shares_by_hand(docs, least, doubt):
    """entity -> term -> share, from plain counts."""
    n, df, by_entity, joint = len(docs), Counter(), Counter(), defaultdict(lambda: [0, set()])
    for text in docs:
        spans = pii.base_spans(text)
        df.update(pii.terms_of(text))
        names = {pii.entity(text, s) for s in spans}
        by_entity.update(names)
        for e in names:
            for w in {w for _, _, w in pii.words_outside(text, spans)}:
                joint[e, w][0] += 1
                joint[e, w][1].add(text)
    pairs = {k: c for k, (c, seen) in joint.items() if len(seen) >= least and by_entity[k[0]] >= least}
    out = {}
    for (e, w), c in pairs.items():
        p, q = c / df[w], by_entity[e] / n
        if p <= q or q >= 1:
            continue
        kl = p * math.log(p / q) + ((1 - p) * math.log((1 - p) / (1 - q)) if p < 1 else 0)
        if df[w] * kl >= math.log(len(pairs) / doubt) and math.log(p / q) / -math.log(q) >= 0.75:
            out[e, w] = math.log(p / q) / -math.log(q)
    return out


def test_shares_agree_with_plain_counts(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(40)]
    docs = []
    for i in range(400):
        text = " ".join(rng.choice(words, 15))
        if i % 8 == 0:
            text += f" Quendor of İzmir wrote a@b.example {'Zork' if i % 16 else ''}"
        if i % 5 == 0:
            text += f" +1 555 010 1000 Straße {words[i % 3] if i % 10 else 'Allee'}"
        docs.append(text)
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").selectExpr("doc_id", "text", "doc_id AS uid")
    common, entities = pii.with_entities(pii.scanned(frame), 3)
    found = {(r["entity"], r["term"]): r["share"] for r in pii.disclosing(common, entities, frame, 3, 0.75).collect()}
    wanted = shares_by_hand(docs, 3, 0.01)
    assert wanted and found.keys() == wanted.keys() and all(abs(found[k] - wanted[k]) < 1e-9 for k in wanted)


def test_only_wanted_terms_are_counted(spark):
    """Few of the terms nobody asked for pass the filter on terms, and a task counts a term once for all its batches."""
    wanted = [f"wanted{i}" for i in range(12_000)] + ["İzmir".lower(), "straße"]
    table = pii.wanted_buckets(spark.createDataFrame([(w,) for w in wanted], "term string"))
    assert all(pii.is_wanted(w, table) for w in wanted)
    assert sum(pii.is_wanted(f"other{i}", table) for i in range(20_000)) < 200
    assert not any(pii.wanted_buckets(spark.createDataFrame([], "term string")))
    docs = spark.createDataFrame([(f"wanted{i % 7} wanted{i % 7} other{i}",) for i in range(3000)], "text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        found = pii._document_frequencies(docs, table).collect()
        some = pii._document_frequencies(docs, table, most=3).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for rows in (found, some):
        counts = {r["term"]: r["df_term"] for r in rows}
        assert {w: counts[w] for w in wanted[:7]} == {f"wanted{i}": len(range(i, 3000, 7)) for i in range(7)}


def test_chance_discloses_nothing(spark):
    """An entity on a third of all documents, and many words that are seen three to five times."""
    rng = np.random.default_rng(12)
    rare = np.repeat([f"rare{i}" for i in range(900)], rng.integers(3, 6, 900))
    where = rng.integers(0, 1500, len(rare))
    docs = [["common", "words", "here"] for _ in range(1500)]
    for w, i in zip(rare, where):
        docs[i].append(w)
    rows = [(i, " ".join(d) + (" boss@corp.example Zanzibar" if i % 3 == 0 else "")) for i, d in enumerate(docs)]
    found = pii.with_spans(spark.createDataFrame(rows, "doc_id long, text string"), text=True).collect()
    marked = {r["text"][s["start"] : s["end"]] for r in found for s in r["spans"] if s["kind"] in ("name", "term")}
    assert marked == {"Zanzibar"}


def test_words_are_cut_alike_for_all_counts(spark):
    """A word on every document is no name, whatever lower case makes of its letters."""
    for word in ("İzmir", "Izmir", "Straße", "ΑΣ", "ﬁn", "x²y", "áb"):
        rows = [(i, f"{word} filler{i} " + ("boss@corp.example" if i % 10 == 0 else "nothing")) for i in range(60)]
        found = pii.with_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert all(s["kind"] == "email" for r in found for s in r["spans"]), word


def test_personal_data_in_awkward_rows(spark):
    long = "filler " * 200_000 + "+1 (988) 555-2485"
    rows = [(1, None), (1, ""), (2, long), (2, long), (None, "a@b.example"), (3, "é" * 10 + " a@b.example")]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, uid int, entities string, term int")
    found = pii.digests(pii.with_spans(frame)).collect()
    assert len(found) == 6 and sorted(r["n_phone"] for r in found) == [0, 0, 0, 0, 1, 1] and sorted(r["n_email"] for r in found) == [0, 0, 0, 0, 1, 1]
    assert {r["spans"] for r in found if r["doc_id"] == 3} == {"email:11:22"}
    assert re.fullmatch(r"phone:\d+:\d+", next(r["spans"] for r in found if r["doc_id"] == 2))


def test_budgets_with_very_long_texts():
    """Long lengths are greedy, the table stays small, and what short texts can reach is reached exactly."""
    from tidemark.llm import mix

    rng = np.random.default_rng(4)
    for _ in range(200):
        lengths = np.unique(rng.integers(1, 40, rng.integers(1, 6)))
        counts = rng.integers(1, 5, len(lengths))
        budget = int(rng.integers(1, max(2, int((lengths * counts).sum()))))
        reachable = {0}
        for length, count in zip(lengths, counts):
            reachable = {r + int(length) * k for r in reachable for k in range(int(count) + 1)}
        for long in (mix.LONG, 10):
            taken = mix.subset(lengths, counts, budget, long)
            off = abs(int((lengths * taken).sum()) - budget)
            assert ((0 <= taken) & (taken <= counts)).all()
            if long == mix.LONG:
                assert off <= min(abs(r - budget) for r in reachable) + 4 * int(lengths.max())
    begin = time.process_time()
    taken = mix.subset(np.array([1, 3, 50_000_000]), np.array([500, 500, 7]), 160_000_000)
    assert taken.tolist() == [500, 500, 3] and time.process_time() - begin < 5
    assert mix.subset(np.array([40_000_000, 50_000_000]), np.array([1, 1]), 48_000_000).tolist() in ([0, 1], [1, 0])


def test_stages_carry_columns_of_any_name(spark):
    """Extra columns named like the helpers of the stages reach the last but one untouched, and decide nothing."""
    from pyspark.sql import functions as F

    import corpus_pipeline

    names = "_id _copies _mark _copy _digest _norm _text_mark entropy lang_pred rejected score text_mark _said _others _key_0 _of n_chars a.b".split()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").drop("n_chars")
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")))
    wide = docs.withColumns({n: F.concat(F.lit(n), F.coalesce(F.col("source"), F.lit("-"))) for n in names})
    quoted = {n: F.col(f"`{n}`") for n in names}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, carried = stage(spark, docs, ""), stage(spark, wide, "")
        assert carried.columns == wide.columns, name
        wrong = [~quoted[n].eqNullSafe(F.concat(F.lit(n), F.coalesce(F.col("source"), F.lit("-")))) for n in names]
        assert carried.filter(F.greatest(*(w.cast("int") for w in wrong)) > 0).isEmpty(), name
        ids = lambda df: sorted((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect())
        assert ids(plain) == ids(carried), name
        assert stage(spark, wide.limit(0), "").isEmpty(), name
    assert corpus_pipeline.STAGES[-1][1](spark, wide, "").count() == corpus_pipeline.STAGES[-1][1](spark, docs, "").count()
