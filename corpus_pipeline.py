"""From raw documents to token ids: quality, exact copies, near copies, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. It reads the columns of documents alone, so that no other
name can clash, and gives an empty result for an empty table. What stages do with nulls, empty and very long texts, ties and repeated rows is said below; texts
are read whole, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionloom.llm import bpe, exact_dedup, mixing, quality_cnn, simhash
from sessionloom.llm.shared import cut

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (operator 4), fitted on the labels that belong to docs.

    Null and empty texts are scored like any other (as padding). Equal texts get equal scores, so repeated rows stay or go together. Without labels the
    untrained network decides.
    """
    model = quality_cnn.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_cnn.score(docs, model, COLUMNS).where("predicted = 1").select(COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (operator 9), that of the largest doc_id; null ids are smallest, and of repeated rows one stays.

    Null and empty texts are equal to each other.
    """
    return exact_dedup.without_copies(docs.select(COLUMNS))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 1): a Jaccard similarity of 0.8 or more over five-word shingles, and chains of such pairs.

    That of the smallest doc_id stays (null ids are largest), with rows that repeat it. Texts without words are alike; null is empty.
    """
    return simhash.first_of_groups(docs.select(COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights (operator 6): documents repeat, always whole, and a source is above its target by less than one.

    Null is a source of its own. Texts that are null or without words have no size and don't come out. Ties of the random order go by size and text.
    """
    return mixing.mixed_documents(docs).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and their digests (operator 7), a row per row of docs; null and empty texts have no token."""
    return bpe.encode(docs, keep=["doc_id", "lang", "source"], outputs=("ids", "sha"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixture), ("encoding", tokens)]

#: The classifier, the 64-bit fingerprints and the encoder are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
