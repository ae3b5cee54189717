"""A corpus from raw documents to packed windows: one function a stage, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import keeping_columns, staged
from tidemark.llm.exact import without_copies
from tidemark.llm.langid import beyond, fit, limits_of, marked, predicted
from tidemark.llm.mix import mixture
from tidemark.llm.near import without_near_copies
from tidemark.llm.pack import packed
from tidemark.llm.queries import tokenizer_path
from tidemark.session import configure


COLUMNS = ("doc_id", "text", "lang", "source")


@keeping_columns(*COLUMNS)
def in_a_known_language(docs: DataFrame) -> DataFrame:
    said = staged(marked(predicted(docs, fit(docs))), "languages")
    return beyond(said, limits_of(said)).filter("NOT rejected").select(*docs.columns)


@keeping_columns(*COLUMNS)
def mixed(docs: DataFrame) -> DataFrame:
    mark = F.xxhash64(F.col("text").cast("string"))
    copies = mixture(docs).groupBy("doc_id", F.col("_tie").alias("_mark")).agg(F.sum(F.col("whole") + F.col("extra")).alias("_copies")).filter("_copies > 0")
    rows = docs.withColumn("_mark", mark).dropDuplicates(["doc_id", "_mark"])
    copies = copies.select(F.col("doc_id").alias("_id"), F.col("_mark").alias("_of"), "_copies")
    taken = rows.join(copies, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_mark").eqNullSafe(F.col("_of")))
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents without a letter and those far from every language that the labelled ones teach.

    Null and empty texts have no letter and go; without labelled rows no language is known
    and all go; rows that repeat are judged each; an empty table stays empty.
    """
    return in_a_known_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text up to white space, the first stays.

    Null and empty texts are equal; of rows that repeat a doc_id and text one stays; a null
    doc_id stays only where all of its group are null; an empty table stays empty.
    """
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more over five-word shingles, the first stays.

    Null and empty texts are linked with nothing and stay; repeats, null doc_ids and an
    empty table are as in `exact_dedup`.
    """
    return without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: never, once or twice.

    Null and empty texts have no words and are never taken; rows that repeat a doc_id and text are
    taken as often as the mix takes all of them; a null source is a source; an empty table stays empty.
    """
    return mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their ids, in windows of 2048.

    Null and empty texts are one piece of the end id; rows that repeat a doc_id are packed
    each; an empty table gives no pieces; other columns are not carried on.
    """
    return packed(docs, tokenizer_path())


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("pack", pack)]

# A trained model, signatures and a tokenizer decide: SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
