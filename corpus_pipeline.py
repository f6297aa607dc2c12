"""From raw documents to packed training sequences: language, near copies, personal data, mix, packing.

Each stage takes all its predecessor kept and is written as Parquet before the next one reads it, so a lost
executor costs at most one stage's tasks. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswright.llm import chosen_path, language, mixing, packing, pii
from corpuswright.session import cut_lineage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and texts whose words are mostly of no learned language; a text may mix languages."""
    return language.keep_known_languages(docs, language.fit(docs, where=~language.held_out()))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return chosen_path.one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and disclosive words; ``n_chars`` follows the text."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of its source ask for."""
    return mixing.mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("near_copies", one_of_each_group),
    ("personal_data", without_personal_data),
    ("mixing", mixed),
    ("packing", packed),
]

# Viterbi labels, token ids and greedy packing have no SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
