"""A corpus pipeline of five stages, each the whole work of one operator on what is left by then."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.llm import queries, stages
from kinspan.llm.packing import pack, tokenized_pieces
from kinspan.llm.quality import fit, labelled_sample
from kinspan.session import fresh_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is a half or more, see `stages.keep_good`.

    A text is scored by itself, a null one as an empty one; without labels every score is a half, so
    all documents stay. The model learns from at most 4,000 labelled rows.
    """
    sample = labelled_sample(docs.select("doc_id", "text"), queries.table(spark, sf_dir, "labels"))
    return stages.keep_good(docs, fit(sample))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id, see `stages.keep_one_of_equal`.

    Null and empty texts are equal, and of rows that repeat an id and its text one stays.
    """
    return stages.keep_one_of_equal(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents the one with the smallest id, see `stages.keep_one_of_near`."""
    return stages.keep_one_of_near(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, see `stages.keep_clean`."""
    return stages.keep_clean(docs, queries.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, in sequences of at most 4,096 tokens: a row per piece, without its ids.

    A null or empty text is one piece, the token that ends a document; long texts have many. Rows that
    repeat an id are documents each. Columns beyond doc_id and text are not read.
    """
    pieces = tokenized_pieces(docs.select("doc_id", "text"))
    return pack(
        pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    )


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("ngram_join", near),
    ("decontaminate", decontaminate),
    ("packing", packed),
]

# A trained model and a tokenizer cannot be put in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
