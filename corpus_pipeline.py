"""From raw documents to token ids, in five stages over what the stage before kept.

Quality rules drop documents, near-duplicate groups keep one document each, live secrets
are masked in the texts, sources are mixed to target weights (documents that are taken
several times are repeated, others dropped), and what is left is encoded. All stages but
the last return the columns of documents. A run of its own writes nothing but checkpoints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import bpe, mixing, quality, secrets, simhash
from cohortlake.llm.common import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from labels."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id."""
    return simhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live secrets masked; ``n_chars`` follows the text."""
    masked = secrets.masked(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Documents without words are never taken."""
    packed = docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    mixed = mixing.mixed(packed).where("taken > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int")))).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and digests of ids and decoded text, a row for each document and repeat."""
    return bpe.digests(docs)


STAGES = [
    ("quality rules", quality_rules), ("SimHash near-dedup", near_duplicates), ("secret scans", secret_scan),
    ("mixing sources", mix_sources), ("BPE encoding", encode),
]

#: Learned rules, fingerprints and a tokenizer's ids are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
