"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (session, documents, folder of the tables) and returns the
documents that the next one reads; all but the last keep the columns of
``documents``.  ``run`` writes what a stage returns to the shared folder and reads it
again, so that a lost executor costs one stage's work at most.

Documents without an id cannot be named by a decision and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantlens.llm import binary_pack, lines, near, pii, quality
from grantlens.session import staged, tune


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs certified on the labels."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many sources share."""
    return _measured(lines.clean_lines(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return near.keep_first(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _measured(pii.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, each with the checksum of its ids."""
    return binary_pack.piece_digests(binary_pack.pack(docs))


def _measured(docs: DataFrame) -> DataFrame:
    """Lengths of the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


STAGES = [
    ("quality", good_quality),
    ("lines", without_boilerplate),
    ("near", one_of_each),
    ("pii", without_personal_data),
    ("packing", packed),
]

# Recursive components, tokenizer ids and certified cutoffs are beyond SQL; tests/llm holds the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the result of the last."""
    tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
