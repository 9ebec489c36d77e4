"""File metrics, the hard-filter verdict with its reason, exact dedup and routing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions import measures as M
from corpuskiln.functions.text import estimated_tokens, normalize_newlines


@dataclass(frozen=True)
class Thresholds:
    """Limits of the hard filters; ``code()`` has those for source files, ``prose()`` lifts the line limits."""

    max_bytes: int = 200_000
    max_non_ascii: float = 0.20
    max_encoded_run: int = 1024
    max_encoded_share: float = 0.50
    max_lines: int = 100_000
    max_mean_line: float = 100
    max_line: int = 1_000
    min_tokens: int = 40
    max_tokens: int = 3596
    max_hex_ratio: float = 0.20

    @staticmethod
    def code() -> Thresholds:
        return Thresholds()

    @staticmethod
    def prose() -> Thresholds:
        return Thresholds(max_mean_line=1e9, max_line=1_000_000_000)


REASONS = (
    "exact_duplicate", "encoded_data", "long_lines", "binary_like", "too_much_nonascii", "too_large_bytes",
    "too_few_lang_tokens", "too_many_lang_tokens", "no_shingles", "hexnum_blob", "too_few_model_tokens",
)


def as_files(documents: DataFrame) -> DataFrame:
    """Documents as files: source/id, language, text, and the id as the order."""
    return documents.select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("filename"), F.col("lang").alias("filetype"), F.col("text").alias("content"), F.col("doc_id").alias("row_ord"))


def file_metrics(df: DataFrame, k: int = 5, model_tokens: Callable[[Column], Column] = M.word_count, lang_tokens: Callable[[Column], Column] = M.code_tokens) -> DataFrame:
    """One row of measures per file; ``num_tokens_lang`` uses the code grammar unless another is given.

    Tokens are counted once and shared by the measures that need them.
    """
    text = normalize_newlines(F.coalesce(F.col("content"), F.lit("")))
    base = df.select("filename", "row_ord", text.alias("content")).withColumn("num_tokens_lang", F.size(lang_tokens(F.col("content"))))
    c, n = F.col("content"), F.col("num_tokens_lang")
    return base.select(
        "filename", "row_ord", M.text_sha1(c).alias("sha1"), M.byte_length(c).alias("bytes"), M.line_count(c).alias("lines"),
        M.mean_line_length(c).alias("avg_line_len"), M.longest_line(c).alias("max_line_len"), M.non_ascii_ratio(c).alias("non_ascii_ratio"),
        M.is_binary_like(c).alias("binary_like"), *[v.alias(name) for name, v in M.encoded_data(c).items()],
        n, F.lit(k).alias("k_shingle"), F.greatest(n - k + 1, F.lit(0)).alias("num_shingles"), M.hex_number_ratio(c, n).alias("hexnum_ratio"),
        model_tokens(c).alias("num_tokens_model"), M.is_junk_path(F.col("filename")).alias("junk_path"),
    )


def basic_metrics(df: DataFrame) -> DataFrame:
    """The second, simpler set of measures, for variant chunks."""
    c = F.col("content")
    names = F.regexp_count(c, F.lit(r"[A-Za-z_][A-Za-z0-9_]*"))
    hits = {
        "enc_hits_base64": F.regexp_count(c, F.lit(r"(?U)\b[A-Za-z0-9+/=]{24,}\b")),
        "enc_hits_hexbytes": F.regexp_count(c, F.lit(r"(?U)\b0x[0-9a-fA-F]+\b")),
        "enc_hits_unicode": F.regexp_count(c, F.lit(r"\\u[0-9a-fA-F]{4}")),
    }
    matched = sum(hits.values(), F.lit(0))
    return df.select(
        *df.columns, M.byte_length(c).alias("bytes"), F.size(F.split(c, "\n")).alias("lines"),
        ((F.length(c) - F.size(F.split(c, "\n")) + 1) / F.size(F.split(c, "\n"))).alias("avg_line_len"), M.longest_line(c).alias("max_line_len"),
        (M.non_ascii_count(c) / F.greatest(F.length(c), F.lit(1))).alias("non_ascii_ratio"), F.contains(c, F.lit("\x00")).cast("int").alias("binary_like"),
        matched.alias("enc_total_matched"), F.coalesce(F.array_max(M.run_lengths(c, "[A-Za-z0-9+/=]+")), F.lit(0)).alias("enc_max_run"),
        (matched / F.greatest(F.length(c), F.lit(1))).alias("enc_fraction"), *[v.alias(k) for k, v in hits.items()], names.alias("num_tokens_lang"),
        M.gram_count(c).alias("num_shingles"), (F.regexp_count(c, F.lit(r"(?U)\b[0-9a-fA-F]{8,}\b")) / F.greatest(names, F.lit(1))).alias("hexnum_ratio"),
        M.word_count(c).alias("num_tokens_model"), estimated_tokens(c).alias("tokens_estimate"),
    )


def mark_duplicates(df: DataFrame, key: str = "sha1", order: str = "row_ord") -> DataFrame:
    """``is_duplicate``: all but the first row of a key.

    The first of each key comes from an aggregation with a map-side combine, so
    a key that many rows share isn't sorted in one task; keys of one row never
    join, as only those with repeats are kept.
    """
    first = df.groupBy(key).agg(F.min(order).alias("__first"), F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    return df.join(first, key, "left").withColumn("is_duplicate", F.coalesce(F.col(order) > F.col("__first"), F.lit(False))).drop("__first")


def verdict(metrics: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """``quality_ok`` and ``fail_reason``, the first rule that trips."""
    model = F.col("num_tokens_model")
    few = F.coalesce(model, F.lit(0))
    rules = (
        F.col("is_duplicate"),
        (F.col("enc_max_run") > limits.max_encoded_run) | (F.col("enc_fraction") > limits.max_encoded_share),
        (F.col("lines") > limits.max_lines) | (F.col("avg_line_len") > limits.max_mean_line) | (F.col("max_line_len") > limits.max_line),
        F.coalesce("binary_like", F.lit(False)),
        F.coalesce("non_ascii_ratio", F.lit(0.0)) > limits.max_non_ascii,
        F.coalesce("bytes", F.lit(0)) > limits.max_bytes,
        few < limits.min_tokens,
        few > limits.max_tokens,
        F.coalesce("num_shingles", F.lit(0)) <= 0,
        F.coalesce("hexnum_ratio", F.lit(0.0)) > limits.max_hex_ratio,
        model.isNotNull() & (model < limits.min_tokens),
    )
    reason = F.lit("ok")
    for name, rule in reversed(list(zip(REASONS, rules))):
        reason = F.when(rule, name).otherwise(reason)
    return mark_duplicates(metrics).withColumn("fail_reason", reason).withColumn("quality_ok", F.col("fail_reason") == "ok").drop("is_duplicate")


def survivors(judged: DataFrame) -> DataFrame:
    return judged.filter("quality_ok").drop("junk_path")


def drop_summary(judged: DataFrame) -> DataFrame:
    return judged.groupBy("fail_reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "fail_reason")


def only_listed(df: DataFrame, listed: DataFrame, key: str = "filename") -> DataFrame:
    """Rows whose key is in the list; every duplicate stays."""
    return df.join(listed.select(key), key, "left_semi")


def not_listed(df: DataFrame, listed: DataFrame, key: str = "filename") -> DataFrame:
    return df.join(listed.select(key), key, "left_anti")


def mark_similar(judged: DataFrame, dropped: DataFrame) -> DataFrame:
    """Losers of a group of near-duplicates fail, with their own reason."""
    lost = dropped.select("filename").distinct().withColumn("__lost", F.lit(True))
    marked = judged.join(lost, "filename", "left")
    return (
        marked.withColumn("fail_reason", F.when(F.col("__lost"), "similiar_file_exists").otherwise(F.col("fail_reason")))
        .withColumn("quality_ok", F.col("quality_ok") & F.col("__lost").isNull())
        .drop("__lost")
    )


def route_test_cases(df: DataFrame) -> DataFrame:
    """``route``: numbered test cases apart, files below ``/tests/`` dropped, the rest main."""
    name = F.col("filename")
    return df.withColumn("route", F.when(name.rlike(r"/\d{3}_testCase"), "test_case").when(F.contains(name, F.lit("/tests/")), "dropped").otherwise("main"))


def pass_counts(results: DataFrame, by: Column, ok: str = "load_ok") -> DataFrame:
    """Passed and failed files by repository or another key; a missing result counts as failed."""
    passed = F.coalesce(F.col(ok), F.lit(False))
    return results.groupBy(by).agg(F.count_if(passed).alias("passed"), F.count_if(~passed).alias("failed"))
