"""Cached model calls: instructions for files, instructions and explanations for masked definitions, text cleaning.

A request is a row with a prompt; its cache key holds the filename, the model,
both prompts, the mode, and where there is one the definition's name and a hash
of its text.  The provider sees only rows without an answer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.measures import text_sha1, text_sha256
from corpuskiln.functions.text import excerpt, has_module_header, strip, without_fences, wrapped_comment
from corpuskiln.functions.machines import strip_all_comments
from corpuskiln.operators.keyed import Provider, call_cached, request_key
from corpuskiln.operators.messages import clean_instruction, input_mode, masked_limits, message, simple_limits, template

ALPACA = "instruction string, input string, output string"
QA = "qa_pairs array<struct<question:string,answer:string>>"


@dataclass(frozen=True)
class Model:
    """Name, system prompt and user template of a call."""

    name: str
    system: str
    user: str


def require(df: DataFrame, columns: Sequence[str]) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns are missing: {missing}")


def _ask(df: DataFrame, model: Model, provider: Provider, cache_path: str, mode: str, *extra: Column) -> DataFrame:
    prompted = df.withColumn("system", F.lit(model.system)).withColumn("prompt", template(model.user, df))
    keyed = prompted.withColumn("key", request_key(F.col("filename"), F.lit(model.name), F.col("system"), F.col("prompt"), F.lit(mode), *extra))
    return call_cached(keyed, cache_path, provider).drop("system", "key")


def instructions(df: DataFrame, model: Model, provider: Provider, cache_path: str, mode: str = "excerpt") -> DataFrame:
    """Adds ``instruction`` for whole files; needs filename, content, num_declarations and total_mcc."""
    require(df, ("filename", "content", "num_declarations", "total_mcc"))
    limits = simple_limits(F.coalesce("num_declarations", F.lit(0)), F.coalesce("total_mcc", F.lit(0.0)))
    ready = df.withColumn("__l", limits).select(*df.columns, "__l.*").withColumn("code_excerpt", excerpt(F.col("content"), 6000)).withColumn("has_module_header", has_module_header(strip_all_comments(F.col("content"))))
    asked = _ask(ready, model, provider, cache_path, mode)
    return asked.select(*df.columns, clean_instruction(F.col("value")).alias("instruction"), input_mode(F.col("content"), mode).alias("input"))


def masked_instructions(df: DataFrame, model: Model, provider: Provider, cache_path: str) -> DataFrame:
    """Adds ``instruction`` for masked definitions, within their own limits."""
    require(df, ("filename", "def_name", "def_params", "masked_source", "target_definition", "total_mcc", "num_declarations", "max_mcc"))
    limits = masked_limits(F.col("total_mcc"), F.col("num_declarations"), F.col("max_mcc"), F.size("def_params"), F.lit("declaration"))
    ready = df.withColumn("__l", limits).select(*df.columns, "__l.*")
    asked = _ask(ready, model, provider, cache_path, "masked", F.col("def_name"), text_sha1(F.col("target_definition")))
    return asked.select(*df.columns, clean_instruction(F.col("value")).alias("instruction"))


def explanations(df: DataFrame, model: Model, provider: Provider, cache_path: str, width: int = 78) -> DataFrame:
    """Adds ``explanation`` and ``explanation_comment``, the same as a wrapped line comment."""
    require(df, ("filename", "def_name", "masked_source", "target_definition", "instruction"))
    asked = _ask(df, model, provider, cache_path, "explain", F.col("def_name"), text_sha1(F.col("target_definition")))
    text = strip(without_fences(F.col("value")))
    return asked.select(*df.columns, text.alias("explanation")).withColumn("explanation_comment", wrapped_comment(F.col("explanation"), width))


def cleaned_texts(df: DataFrame, provider: Provider, cache_path: str) -> DataFrame:
    """Adds ``processed``, asked for once per distinct text; without an answer the text stays as it is."""
    keyed = df.withColumn("key", text_sha256(F.col("content")))
    return call_cached(keyed, cache_path, provider).withColumn("processed", F.coalesce("value", "content")).drop("value", "key")


def parsed_rows(df: DataFrame, column: str = "value", schema: str = ALPACA) -> DataFrame:
    """Answers as columns of a schema; ``valid`` says whether every field is there."""
    out = df.withColumn("__r", F.from_json(column, schema))
    fields = [f.split()[0] for f in schema.split(", ")]
    present = F.lit(True)
    for f in fields:
        present = present & F.col(f"__r.{f}").isNotNull()
    return out.select(*df.columns, *[F.col(f"__r.{f}").alias(f) for f in fields], F.coalesce(present, F.lit(False)).alias("valid"))


def completion_messages(df: DataFrame, system: str) -> DataFrame:
    """Fill-the-hole chats: the masked source is asked about, its definition is the answer."""
    require(df, ("instruction", "masked_source", "target_definition"))
    user = F.concat(F.lit("## Task\n"), "instruction", F.lit("\n\n## Code\n```cryptol\n"), "masked_source", F.lit("\n```"))
    answer = F.concat(F.lit("```cryptol\n"), "target_definition", F.lit("\n```"))
    return df.withColumn("messages", F.array(message("system", F.lit(system)), message("user", user), message("assistant", answer)))
