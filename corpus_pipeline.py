"""A corpus pipeline of four stages over ``documents``.

Language ID rejects texts of no known language, line dedup takes out repeated
passages, near-dedup keeps one document of each group of copies, packing lays
what is left into training sequences.  Each stage is written as Parquet and
reread as the next one's documents; every stage but the last returns the
columns of ``documents``.

Defined results: a null text, one without a letter and one that no learned
language codes well are rejected, and all are if no row has a language; rows
without a language are otherwise treated as any.  Null ids, repeated rows and
extra columns pass through the first three stages as each of them states; of
repeated rows one stays.  An empty table gives no pieces.  The stages' results
are written to a folder of their own beside the checkpoints and stay there for
whoever reads the result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpuskiln.llm import language_id, line_dedup, near_dedup, packing
from corpuskiln.llm.registry import END_ID, WORD_BPE
from corpuskiln.session import ensure_checkpoint_dir, ship

#: SQL can't express the learned language models, so a brute-force version is the test's oracle.
ORACLE_SQL = None


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go."""
    ship(spark)
    return language_id.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three repeated lines go; ``n_chars`` follows the text."""
    ship(spark)
    return line_dedup.remove_repeated_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship(spark)
    return near_dedup.keep_one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in training sequences."""
    ship(spark)
    return packing.pack_texts(docs, WORD_BPE, END_ID)


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
