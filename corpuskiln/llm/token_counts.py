"""Exact length histogram of encoded documents.

Documents are counted by their encoded length; totals over the histogram then
answer every context limit at once.  With ``H(n)`` documents of length ``n``,
the documents longer than a limit are a suffix sum of ``H`` and the tokens left
by truncation are ``sum(n * H(n), n <= limit) + limit * longer``.

Defined results: a null text counts as empty and has length 0; an empty table
gives no row; repeated rows count each time.  Lengths come from whole texts.

The histogram has as many rows as there are distinct lengths, which is at most
``sqrt(2 * tokens)``, however many documents there are.  Its running sums are
taken in two levels (blocks of lengths, then within a block), so no task ever
holds more than one block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.llm.byte_bpe import MEMO_ENTRIES, memo
from corpuskiln.session import cut

#: Lengths of one block of the two-level running sums.
BLOCK = 4096


def token_lengths(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """One column ``n_tokens``, a row per document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, pieces = memo(ranks_path, pattern)
            counts = []
            for text in batch.column(0):
                n = 0
                for ids, _ in map(known.__getitem__, pieces.findall(text.as_py() or "")):
                    n += 1 + ids.count(",")
                counts.append(n)
                if len(known) > MEMO_ENTRIES:
                    known.clear()
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["n_tokens"])

    return df.select(F.col(text_col).cast("string").alias("__text")).mapInArrow(run, "n_tokens bigint")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Per distinct length: documents, and what a context limit of that length keeps.

    Columns: context_limit, n_docs (of just that length), docs_within,
    docs_longer, tokens_within (of documents within the limit),
    truncated_tokens (kept if every document is cut at the limit),
    total_tokens and quantile (share of documents within the limit).
    """
    # both levels read the counts; without the cut every text would be encoded twice
    counts = cut(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")))
    counts = counts.withColumn("__block", F.expr(f"n_tokens div {BLOCK}"))
    block = counts.groupBy("__block").agg(F.sum("n_docs").alias("__docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("__tokens"))
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    block = block.select(
        F.col("__block").alias("__of"),
        F.coalesce(F.sum("__docs").over(before), F.lit(0)).alias("__docs_before"),
        F.coalesce(F.sum("__tokens").over(before), F.lit(0)).alias("__tokens_before"),
        F.sum("__docs").over(every).alias("__all_docs"),
        F.sum("__tokens").over(every).alias("__all_tokens"),
    )
    up_to = Window.partitionBy("__block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    joined = (
        counts.withColumn("__docs_in", F.sum("n_docs").over(up_to))
        .withColumn("__tokens_in", F.sum(F.col("n_docs") * F.col("n_tokens")).over(up_to))
        .join(block, F.col("__block") == F.col("__of"))
        .withColumn("docs_within", F.col("__docs_before") + F.col("__docs_in"))
        .withColumn("tokens_within", F.col("__tokens_before") + F.col("__tokens_in"))
        .withColumn("docs_longer", F.col("__all_docs") - F.col("docs_within"))
    )
    return joined.select(
        F.col("n_tokens").alias("context_limit"),
        "n_docs",
        "docs_within",
        "docs_longer",
        "tokens_within",
        (F.col("tokens_within") + F.col("n_tokens") * F.col("docs_longer")).alias("truncated_tokens"),
        F.col("__all_tokens").alias("total_tokens"),
        (F.col("docs_within") / F.col("__all_docs")).alias("quantile"),
    )


def limits_report(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """What any given limits keep: one row per limit, from the histogram alone."""
    each = histogram.select("context_limit", "n_docs", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("limit"))
    return each.groupBy("limit").agg(
        F.sum(F.when(F.col("context_limit") <= F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_within"),
        F.sum(F.least("context_limit", "limit") * F.col("n_docs")).alias("truncated_tokens"),
        F.sum(F.col("context_limit") * F.col("n_docs")).alias("total_tokens"),
    )


def length_quantiles(histogram: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The smallest length that at least the given shares of documents don't exceed."""
    each = histogram.select("context_limit", "quantile", F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share"))
    return each.filter(F.col("quantile") >= F.col("share")).groupBy("share").agg(F.min("context_limit").alias("n_tokens"))
