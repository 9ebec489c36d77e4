"""Queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.llm import ann, byte_bpe, chat_format, fingerprints, html_extract, language_id, line_dedup, near_dedup, packing, token_counts
from corpuskiln.plans.registry import Query, Registry, table

LLM = Registry()

BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


@LLM.add("op1_line_dedup", line_dedup.SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


@LLM.add("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf_dir, "documents"), WORD_BPE, END_ID)


@LLM.add("packing_conversations")
def packing_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole turns under three limits that all bind: tokens, segments and loss-bearing tokens."""
    turns = packing.encode_turns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), WORD_BPE, END_ID)
    turns = turns.select(F.struct("conv_id", "turn").alias("key"), "ids", "loss")
    packed = packing.pack_examples(turns, packing.Limits(tokens=1024, segments=24, loss_tokens=384), "key", loss_col="loss")
    return packed.select("key.*", *packed.columns[1:])


@LLM.add("op3_near_dedup")
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@LLM.add("op4_nearest_neighbours")
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


@LLM.add("op5_fingerprints")
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_and_edit(table(spark, sf_dir, "documents"))


@LLM.add("op6_chat_formatting")
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


@LLM.add("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


@LLM.add("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


@LLM.add("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_decode(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)


@LLM.add("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.token_lengths(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)
    return token_counts.length_histogram(lengths)


@LLM.add("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(LLM.queries)


def oracle_sql() -> dict[str, str]:
    return dict(LLM.sql)
