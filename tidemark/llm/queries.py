"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.staging import new_path
from tidemark.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op2_pack")
def op2_pack(spark, sf_dir):
    from tidemark.llm.pack import packed

    pieces = packed(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "padded_length"
    )


def held_out():
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2


@query("op3_langid")
def op3_langid(spark, sf_dir):
    from tidemark.llm.common import staged
    from tidemark.llm.langid import beyond, fit, limits_of, marked, predicted

    docs = table(spark, sf_dir, "documents")
    # Every row is scored once; the limits come from the scores of the learned ones.
    said = marked(predicted(docs.select("doc_id", "lang", "text"), fit(docs.filter(~held_out()))))
    said = staged(said.drop("text"), "languages")
    return beyond(said, limits_of(said.filter(~held_out()))).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query("op4_token_files")
def op4_token_files(spark, sf_dir):
    from tidemark.llm.tokenbin import token_digests

    return token_digests(table(spark, sf_dir, "documents"), new_path(spark, "token-files"), tokenizer_path(), end_id=0)


@query(
    "op6_exact",
    r"""
    WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM norm WINDOW w AS (PARTITION BY t)
    """,
)
def op6_exact(spark, sf_dir):
    from tidemark.llm.exact import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


@query("op9_warc")
def op9_warc(spark, sf_dir):
    from tidemark.llm.warc import capture_digests, captures, read_records, write_archives

    path = new_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return capture_digests(captures(read_records(spark, path)))


@query("op10_mix")
def op10_mix(spark, sf_dir):
    from tidemark.llm.mix import mixture

    return mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op5_main_text")
def op5_main_text(spark, sf_dir):
    from tidemark.llm.wrapper import main_text

    return main_text(table(spark, sf_dir, "pages"))


@query("op8_personal_data")
def op8_personal_data(spark, sf_dir):
    from tidemark.llm.pii import digests, with_spans

    return digests(with_spans(table(spark, sf_dir, "documents")))


@query("op7_neighbours")
def op7_neighbours(spark, sf_dir):
    from tidemark.llm.ann import neighbours

    found = neighbours(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", every=100)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), F.col("distance").alias("score"))


@query("op1_near_copies")
def op1_near_copies(spark, sf_dir):
    from tidemark.llm.near import Settings, near_components

    return near_components(table(spark, sf_dir, "documents"), Settings(words=2)).drop("mark")


@query(
    "op11_filter_audit",
    r"""
    WITH RECURSIVE docs AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
    words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
    failed AS (
        SELECT part, coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good, coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic,
            (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
            + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
            + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
        FROM words
    ),
    counted AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY ALL),
    letter(filter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    steps(filter_order, step, done, bit) AS (
        SELECT filter, 1, 0, bit FROM letter
        UNION ALL SELECT filter_order || filter, step + 1, done + s.bit, l.bit FROM steps s, letter l WHERE (done + s.bit) & l.bit = 0
    ),
    orders AS (
        SELECT o.filter_order, s.step, s.done, s.bit FROM steps o JOIN steps s ON starts_with(o.filter_order, s.filter_order) WHERE o.step = 5
    ),
    told AS (
        SELECT part, filter_order, step, bit,
            sum(CASE WHEN mask & (done | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
            sum(CASE WHEN mask & done = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
            sum(CASE WHEN mask & done > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
            sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
            sum(CASE WHEN mask & done = 0 AND mask & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
            sum(CASE WHEN mask & done = 0 AND mask & bit > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
        FROM counted, orders GROUP BY ALL
    )
    SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM told
    """,
)
def op11_filter_audit(spark, sf_dir):
    from tidemark.llm.audit import audit_documents

    return audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op12_near_vectors",
    """
    WITH RECURSIVE sound AS (
        SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
            AND len([x FOR x IN embedding IF x <> 0]) > 0
    ),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93
    ),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
    counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
        e.vec_id = least(e.vec_id, coalesce(l.b, e.vec_id)) AS kept
    FROM embeddings e LEFT JOIN counted c ON e.vec_id = c.a LEFT JOIN least l ON e.vec_id = l.a
    """,
)
def op12_near_vectors(spark, sf_dir):
    from tidemark.llm.pivots import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


@query("op13_whiten")
def op13_whiten(spark, sf_dir):
    from tidemark.llm.whiten import whiten

    return whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
