"""Comment policies: decisions by cache, provider or rule, and the three variants of a source file."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions import machines
from corpuskiln.functions.measures import text_sha1
from corpuskiln.functions.text import collapse_blank_lines, keep_comment, language_of, normalize_newlines, separation_policy, strip_line_comments
from corpuskiln.operators.chunks import line_chunks
from corpuskiln.operators.quality import basic_metrics

VARIANTS = ("with_comments", "without_comments", "hybrid")
Decide = Callable[[Column], Column]


def simple_variants(files: DataFrame) -> DataFrame:
    """filename, variant, content: as it is, without any comment, without line comments."""
    c = F.col("content")
    stripped = F.concat(collapse_blank_lines(machines.strip_all_comments(c)), F.lit("\n"))
    hybrid = F.concat(collapse_blank_lines(strip_line_comments(c)), F.lit("\n"))
    rows = F.array(*[F.struct(F.lit(v).alias("variant"), x.alias("content")) for v, x in zip(VARIANTS, (c, stripped, hybrid))])
    return files.select("filename", F.inline(rows))


def _content_key() -> Column:
    return F.sha2(F.col("content").cast("binary"), 256)


def _marks(comments: DataFrame, column: str) -> DataFrame:
    """(__key, __kept): the decisions of each content in order; files of equal content have equal ones, whatever their names."""
    return comments.groupBy("__key").agg(F.transform(F.array_sort(F.collect_set(F.struct("n", column))), lambda x: x[column]).alias("__kept"))


def comments_of(files: DataFrame, *keys: str) -> DataFrame:
    """One row per comment: filename, ``keys``, n, start, end, kind, text, context and sha1."""
    each = files.filter("content IS NOT NULL").select("filename", *keys, F.posexplode(machines.policy_spans_of(F.col("content"))).alias("n", "s"))
    return each.select("filename", *keys, "n", "s.*").withColumn("sha1", text_sha1(F.col("text")))


def decided(comments: DataFrame, cache: DataFrame | None = None, decide: Decide = keep_comment) -> DataFrame:
    """``keep`` of each comment: from the cache (sha1, keep) if it's there, else by the rule or provider."""
    if cache is None:
        return comments.withColumn("keep", decide(F.col("text")))
    known = cache.filter("sha1 IS NOT NULL AND keep IS NOT NULL").groupBy("sha1").agg(F.last("keep").alias("__keep")) if "ts" not in cache.columns else cache.groupBy("sha1").agg(F.max_by("keep", "ts").alias("__keep"))
    return comments.join(known, "sha1", "left").withColumn("keep", F.coalesce("__keep", decide(F.col("text")))).drop("__keep")


def strip_by_decision(files: DataFrame, cache: DataFrame | None = None, decide: Decide = keep_comment) -> tuple[DataFrame, DataFrame]:
    """(comments with their decision, files without the dropped ones)."""
    files = files.withColumn("__key", _content_key())
    comments = decided(comments_of(files, "__key"), cache, decide)
    marks = _marks(comments, "keep")

    @F.udf("string", useArrow=True)
    def rebuild(text, kept):
        return text if kept is None else machines.drop_spans(text, machines.policy_spans(text), list(kept))

    out = files.join(marks, "__key", "left").withColumn("content", rebuild(F.col("content"), F.col("__kept"))).drop("__kept", "__key")
    return comments.drop("__key"), out


def hybrid_policy(files: DataFrame, decide: Decide = keep_comment) -> tuple[DataFrame, DataFrame]:
    """(files whose dropped comments are blanked, comment index rows)."""
    files = files.withColumn("__key", _content_key())
    spans = files.filter("content IS NOT NULL").select("filename", "__key", F.posexplode(machines.spans_of(F.col("content"))).alias("n", "s")).select("filename", "__key", "n", "s.*").withColumn("kept", decide(F.col("text")))
    index = spans.select("filename", F.col("start").alias("span_start"), F.col("end").alias("span_end"), "kind", text_sha1(F.col("text")).alias("comment_sha1"), "kept", F.length("text").alias("length"))
    marks = _marks(spans, "kept")

    @F.udf("string", useArrow=True)
    def rebuild(text, kept):
        if kept is None:
            return text
        order = iter(list(kept))
        return machines.blank_comments(text, lambda s: bool(next(order)))[0]

    return files.join(marks, "__key", "left").withColumn("content", rebuild(F.col("content"), F.col("__kept"))).drop("__kept", "__key"), index


def build_variants(files: DataFrame, variants: Sequence[str] = VARIANTS, context_tokens: int = 4096, reserve_tokens: int = 512, overlap_tokens: int = 64, chars_per_token: float = 4.0, decide: Decide = keep_comment) -> DataFrame:
    """Chunks of every variant with language, hash, place and measures."""
    base = files.select("filename", normalize_newlines(F.col("content")).alias("content"))
    frames = {
        "with_comments": base,
        "without_comments": base.withColumn("content", machines.without_comments(F.col("content"))),
        "hybrid": hybrid_policy(base, decide)[0],
    }
    rows = None
    for v in variants:
        one = frames[v].select("filename", F.lit(v).alias("variant"), separation_policy(F.col("content")).alias("content"))
        rows = one if rows is None else rows.unionByName(one)
    budget = max(1, context_tokens - reserve_tokens)
    chunks = line_chunks(rows, "content", budget, overlap_tokens, chars_per_token).drop("content").withColumnRenamed("chunk", "content")
    chunks = chunks.withColumn("lang", language_of(F.col("filename"))).withColumn("sha1", text_sha1(F.col("content"))).withColumn("nchars", F.length("content"))
    return basic_metrics(chunks.withColumn("context_window_tokens", F.lit(context_tokens)).withColumn("prompt_reserve_tokens", F.lit(reserve_tokens)))
