import math
import re
from itertools import permutations

import numpy as np
import pytest

import check
from tidemark.llm.audit import audit_documents, filter_audit
from tidemark.llm.pivots import near_vectors, roots, spread_out
from tidemark.llm.queries import QUERIES
from tidemark.llm.whiten import one_sided_jacobi, pivoted_cholesky, whiten

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, _row string, part int, _digest string, done int"
LABELS = "doc_id long, quality int, toxic int, step int"
VECTORS = "vec_id long, embedding array<float>, label string, cls string, rank int, key string"


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_near_vectors"])
def test_query_agrees_with_sql(spark, name):
    assert check.difference(spark, check.connect(SF), name, SF) is None


def audit_by_hand(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (other or "") == text for j, other, _ in docs):
            fails.add("E")
        rows.append((i, source or "", fails))
    out = set()
    for part in {p for _, p, _ in rows}:
        mine, shapley, told = [r for r in rows if r[1] == part], dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left, gone = list(mine), []
            for k, f in enumerate(order):
                removed = [r for r in left if f in r[2]]
                redundant = sum(f in r[2] for r in gone)
                left = [r for r in left if f not in r[2]]
                gone += removed
                shapley[f] += len(removed)
                told.append((part, "".join(order), k + 1, len(left), len(removed), redundant, sum(r[2] == {f} for r in mine), sum(r[0] in good for r in removed), sum(r[0] in toxic for r in removed), f))
        out |= {(*t[:-1], shapley[t[-1]]) for t in told}
    return out


def audit_rows(df):
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = [tuple(r[n] for n in names) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_audit_agrees_with_counting_by_hand(spark):
    rng = np.random.default_rng(3)
    long = " ".join(f"word{i}" for i in range(220))
    texts = [None, "", " \t ", "short", long, long + " $", long.upper(), "same " * 230, "SAME " * 230 + "#", "É" * 400 + " a", "x" * 50_000, "| " + long, long + " tail", "*"]
    docs = [(i, texts[k % len(texts)], [None, "", "a", "bä"][int(rng.integers(4))]) for i, k in enumerate(rng.integers(0, len(texts), 160).tolist())]
    # Rows that repeat a doc_id, with the same and with another text, and rows without one.
    docs += [docs[5], docs[5], (9, "another text", "a"), (None, long, "a"), (None, long, None)]
    labels = [(i, int(rng.integers(2)), int(rng.integers(2))) for i in range(0, 160, 2)] + [(4, 1, 1), (4, 1, 1), (None, 1, 1), (7, None, None), (9999, 1, 1)]
    df = spark.createDataFrame([(*d, "x", 1, "y", 2) for d in docs], DOCS).repartition(7)
    got = audit_documents(df, spark.createDataFrame([(*x, 1) for x in labels], LABELS))
    assert audit_rows(got) == audit_by_hand(docs, labels)


def test_audit_of_nothing_and_of_clean_rows(spark):
    no_labels = spark.createDataFrame([], LABELS)
    assert audit_documents(spark.createDataFrame([], DOCS), no_labels).count() == 0
    text = " ".join(f"w{i}" for i in range(300))
    clean = audit_documents(spark.createDataFrame([(1, text, "s", "", 1, "", 1)], DOCS), no_labels).collect()
    assert len(clean) == 600 and {(r["kept"], r["removed"], r["redundant"], r["shapley"]) for r in clean} == {(1, 0, 0, 0)}


def test_audit_takes_any_number_of_filters(spark):
    rows = spark.createDataFrame([(i, i, "p") for i in range(6)], "_row long, doc_id long, part string")
    tables = {"X": rows.filter("_row < 4").select("_row", "part"), "Y": rows.filter("_row > 2").select("_row", "part")}
    got = filter_audit(rows, tables, {"lost": rows.filter("doc_id = 3").select("doc_id")})
    found = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["lost"], r["shapley"]) for r in got.collect()}
    assert found == {("XY", 1): (2, 4, 0, 3, 1, 7), ("XY", 2): (0, 2, 1, 2, 0, 5), ("YX", 1): (3, 3, 0, 2, 1, 5), ("YX", 2): (0, 3, 1, 3, 0, 7)}


def near_by_hand(vectors, threshold=0.93):
    links = [set() for _ in vectors]
    sound = [v is not None and x is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v) for _, v, x in vectors]
    for a, (_, v, x) in enumerate(vectors):
        for b in range(a):
            if sound[a] and sound[b] and x == vectors[b][2] and len(v) == len(vectors[b][1]):
                p, q = np.array(v, dtype=np.float32).astype(float), np.array(vectors[b][1], dtype=np.float32).astype(float)
                p, q = p / np.abs(p).max(), q / np.abs(q).max()
                if p @ q / np.sqrt((p @ p) * (q @ q)) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    out, seen = [], {}
    for a in range(len(vectors)):
        if a not in seen:
            group, todo = {a}, [a]
            while todo:
                new = links[todo.pop()] - group
                group |= new
                todo += new
            ids = [vectors[g][0] for g in group if vectors[g][0] is not None]
            seen.update(dict.fromkeys(group, min(ids, default=None)))
        out.append((vectors[a][0], len(links[a]), seen[a], vectors[a][0] == seen[a]))
    return sorted(out, key=repr)


def near_rows(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect()), key=repr)


def vectors_frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], x, "c", 1, "k") for i, v, x in vectors], VECTORS)


def test_near_vectors_agree_with_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(90, 16))
    vectors = [(i, v.tolist(), "ab"[i % 2]) for i, v in enumerate(base)]
    tight = base[0] + rng.normal(size=(120, 16)) * 0.02
    vectors += [(200 + i, v.tolist(), "a") for i, v in enumerate(tight)]
    # A chain whose ends are not linked, copies, a scaled copy, another label, and ids that repeat.
    angles = np.arange(8) * 0.3
    vectors += [(400 - i, [*(10 * np.cos(t), 10 * np.sin(t)), *[0.0] * 14], "a") for i, t in enumerate(angles)]
    vectors += [(500 + i, base[1].tolist(), "b") for i in range(30)] + [(600, (base[1] * 1e20).tolist(), "b"), (601, (base[1] * 1e-20).tolist(), "b"), (602, base[1].tolist(), "a"), (3, base[3].tolist(), "b"), (3, base[4].tolist(), "b")]
    vectors += [(700, None, "a"), (701, [0.0] * 16, "a"), (702, [None] + [1.0] * 15, "a"), (703, [float("nan")] * 16, "a"), (704, [float("inf")] + [0.0] * 15, "a"), (705, base[1].tolist(), None), (706, [], "a"), (707, [1.0, 2.0], "a"), (708, [1.0, 2.1], "a"), (None, base[2].tolist(), "a"), (None, [-0.0] * 16, "a")]
    frame = vectors_frame(spark, vectors)
    wanted = near_by_hand(vectors)
    assert near_rows(near_vectors(frame, "vec_id", "embedding", "label")) == wanted
    # Blocks of a few vectors, and few reference points, change nothing.
    assert near_rows(near_vectors(frame, "vec_id", "embedding", "label", pivots=6, prefix=5, shared=2, block=16)) == wanted


def test_near_vectors_of_nothing(spark):
    assert near_vectors(vectors_frame(spark, []), "vec_id", "embedding", "label").count() == 0
    lone = near_vectors(vectors_frame(spark, [(1, None, "a"), (2, [0.0], "a")]), "vec_id", "embedding", "label")
    assert near_rows(lone) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_pairs_at_the_threshold_are_found(spark):
    """Random directions with cosine 0.931: the index finds nearly all of them, and nothing else."""
    rng = np.random.default_rng(9)
    a, noise = rng.normal(size=(2, 700, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    noise -= (noise * a).sum(1)[:, None] * a
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    b = 0.931 * a + math.sqrt(1 - 0.931**2) * noise
    vectors = [(i, v.tolist(), "a") for i, v in enumerate(np.concatenate([a, b]))]
    got = near_rows(near_vectors(vectors_frame(spark, vectors), "vec_id", "embedding", "label"))
    found = sum(n for _, n, _, _ in got) / 2
    assert 0.99 * 700 <= found <= 700
    assert all(c == i % 700 for i, n, c, _ in got if n)


def test_reference_points_are_apart():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 8))
    v[100:] = v[0] + rng.normal(size=(200, 8)) * 0.01
    v /= np.linalg.norm(v, axis=1)[:, None]
    points = spread_out(v, 50, 0.7)
    cosines = points @ points.T - np.eye(len(points))
    assert len(points) <= 50 and cosines.max() < 0.7
    assert roots(6, np.array([0, 1, 4]), np.array([1, 3, 5])).tolist() == [0, 0, 2, 0, 4, 4]


def whitened_by_hand(vectors, components=8):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors])
    n, total = len(x), x.sum(0)
    y = x - total / n
    values, basis = np.linalg.eigh(y.T @ y / n)
    values, basis = values[::-1], basis[:, ::-1]
    return [int(((n * row - total) ** 2).sum()) for row in x], (y @ basis[:, :components]) / np.sqrt(values[:components]), values[:components] / values.sum()


def test_whitening_agrees_with_a_symmetric_solver(spark):
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(400, 12)) * np.linspace(0.2, 3, 12) @ rng.normal(size=(12, 12))
    rows = [(i, v.tolist(), "a") for i, v in enumerate(vectors)]
    dropped = [(900, None, "a"), (901, [1.0, None] + [0.0] * 10, "a"), (902, [float("nan")] * 12, "a"), (903, [float("-inf")] * 12, "a"), (904, [], "a"), (905, [1.0, 2.0], "a")]
    got = whiten(vectors_frame(spark, rows + dropped).repartition(6), "vec_id", "embedding").collect()
    far, white, share = whitened_by_hand(vectors)
    assert sorted((r["vec_id"], r["component"]) for r in got) == [(i, k) for i in range(400) for k in range(1, 9)]
    assert {r["n"] for r in got} == {400} and len({r["identity_error"] for r in got}) == 1
    assert 0 <= got[0]["identity_error"] < 1e-9
    mine = np.zeros((400, 8))
    for r in got:
        assert r["deviation"] == r["deviation_wide"] == far[r["vec_id"]]
        assert abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-10
        mine[r["vec_id"], r["component"] - 1] = r["whitened"]
    sign = np.sign((mine * white).sum(0))
    assert np.abs(mine * sign - white).max() < 1e-8


def test_whitening_of_few_dimensions_and_rows(spark):
    empty = whiten(vectors_frame(spark, []), "vec_id", "embedding")
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_wide"] or empty.count() == 0
    assert whiten(vectors_frame(spark, [(1, [1.0, 2.0], "a")] * 3), "vec_id", "embedding").count() == 0
    # On a line: one component, for every row, rows that repeat an id included.
    line = [(i % 5, [float(i), 2.0 * i, -float(i)], "a") for i in range(20)] + [(None, [0.0, 0.0, 0.0], "a")]
    got = whiten(vectors_frame(spark, line), "vec_id", "embedding").collect()
    assert len(got) == 21 and {r["component"] for r in got} == {1}
    assert abs(got[0]["explained"] - 1) < 1e-12 and got[0]["identity_error"] < 1e-9
    # Deviations beyond 64 bits are null, and whole in the wide column.
    big = [(i, [float(2.0**40 * i)] * 2, "a") for i in range(3)]
    got = {r["vec_id"]: r for r in whiten(vectors_frame(spark, big), "vec_id", "embedding").collect()}
    x = [1024 * 2**40 * i + 100000 for i in range(3)]
    assert got[0]["deviation"] is None and int(got[0]["deviation_wide"]) == 2 * (3 * x[0] - sum(x)) ** 2 and got[1]["deviation"] == 0


def test_factor_and_rotations_give_the_decomposition():
    rng = np.random.default_rng(2)
    for size, rank in ((1, 1), (5, 5), (9, 4), (40, 40)):
        a = rng.normal(size=(size, rank)) * 10.0 ** rng.integers(-3, 4, rank)
        matrix = a @ a.T
        factor = pivoted_cholesky(matrix)
        assert factor.shape[1] <= size and np.allclose(factor @ factor.T, matrix, rtol=1e-9, atol=1e-9 * matrix.max())
        values, vectors = one_sided_jacobi(factor)
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-9)
        assert np.allclose(np.linalg.eigvalsh(matrix)[::-1][:4], values[:4], rtol=1e-8, atol=1e-9 * values[0])
    assert pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
