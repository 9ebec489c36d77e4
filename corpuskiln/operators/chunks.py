"""Chunks of text and token ids, retrieval and context packing."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.functions import machines
from corpuskiln.functions.binding import let
from corpuskiln.operators.splits import global_rank

#: Queries that may be sent to every task.
MAX_QUERIES = 10_000
#: Rows that are compared with all queries at once.
ROWS_AT_ONCE = 256


def fixed_chunks(df: DataFrame, text: str, max_tokens: int, overlap_tokens: int = 64, chars_per_token: float = 4.0) -> DataFrame:
    """(chunk_idx from 1, chunks_total, chunk) of equal windows, as an expression."""
    width, step = int(max_tokens * chars_per_token), int((max_tokens - overlap_tokens) * chars_per_token)
    n = F.length(text)
    count = F.when(n <= width, 1).otherwise(F.ceil((n - width) / step) + 1).cast("int")
    starts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: i * step)
    pieces = F.transform(starts, lambda s: F.substring(F.col(text), s + 1, F.lit(width)))
    each = df.withColumn("chunks_total", count).select("*", F.posexplode(pieces).alias("__i", "chunk"))
    return each.withColumn("chunk_idx", F.col("__i") + 1).drop("__i")


def line_chunks(df: DataFrame, text: str, max_tokens: int, overlap_tokens: int = 64, chars_per_token: float = 4.0) -> DataFrame:
    """As ``fixed_chunks``, ending at line feeds where one lies in a window's second half."""
    pieces = machines.budget_chunks(max_tokens, overlap_tokens, chars_per_token)(F.col(text))
    each = df.withColumn("__c", pieces).withColumn("chunks_total", F.size("__c")).select("*", F.posexplode("__c").alias("__i", "chunk")).drop("__c")
    return each.withColumn("chunk_idx", F.col("__i") + 1).drop("__i")


def id_chunks(ids: Column, max_len: int, stride: int) -> Column:
    """Windows of ``max_len`` ids that overlap by ``stride``; none of an empty list."""
    if max_len <= 0 or not 0 <= stride < max_len:
        raise ValueError("max_len must be positive and stride below it")
    step = max_len - stride


    def windows(x: Column) -> Column:
        last = F.greatest(F.ceil((F.size(x) - max_len) / step), F.lit(0)).cast("int")
        return F.when(F.size(x) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(x, i * step + 1, max_len))).otherwise(F.array().cast("array<array<int>>"))

    return let(ids, windows)


def explode_id_chunks(df: DataFrame, ids: str = "input_ids", max_len: int = 4096, stride: int = 256, pad: int | None = None) -> DataFrame:
    """filename, chunk_index from 0, input_ids padded if asked, n_tokens without padding."""
    each = df.select("filename", F.posexplode(id_chunks(F.col(ids), max_len, stride)).alias("chunk_index", "__c"))
    out = F.col("__c") if pad is None else F.concat(F.col("__c"), F.array_repeat(F.lit(pad), F.lit(max_len) - F.size("__c")))
    return each.select("filename", "chunk_index", out.alias("input_ids"), F.size("__c").alias("n_tokens"))


def tokenize(df: DataFrame, text: str, load: Callable[[], Callable[[list[str]], list[list[int]]]]) -> DataFrame:
    """Adds input_ids and n_tokens by a provider that each worker loads once; NULs are replaced first."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = load()
        for texts in batches:
            yield pd.Series(run(texts.fillna("").str.replace("\x00", "�").tolist()))

    return df.withColumn("input_ids", encode(F.col(text))).withColumn("n_tokens", F.size("input_ids"))


def markdown(df: DataFrame, text: str = "text", source: str = "source", most: int = 1800, overlap: int = 200, least: int = 600) -> DataFrame:
    """(id, text, source, section_start, section_end, start_char) of every chunk of every page."""
    return df.select(F.inline(machines.markdown_chunks_of(F.col(text), F.col(source), most, overlap, least)))


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance, summed in double precision from the first component."""
    parts = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)


def nearest(df: DataFrame, query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest rows to one vector, with rank; a top-k that keeps k rows a task."""
    scored = df.withColumn("distance", squared_distance(F.col(vector_col), query)).orderBy("distance", id_col).limit(k)
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("distance", id_col)))


class _Nearest:
    """The k nearest rows to each of some vectors of one length, over batches of rows.

    A product of matrices, whose error is bounded, tells which rows of a batch
    could be among the k nearest so far; only those are measured exactly, summed
    in double precision from the first component as ``squared_distance`` does.
    """

    def __init__(self, of: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.of, self.queries, self.k = of, queries, k
        self.lengths = (queries * queries).sum(axis=1)
        self.at, self.who, self.near = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        self.most = np.full(len(of), np.inf)

    def take(self, rows: np.ndarray, names: np.ndarray) -> None:
        with np.errstate(all="ignore"):
            sums = self.lengths[:, None] + (rows * rows).sum(axis=1)[None]
            rough = sums - 2 * (self.queries @ rows.T)
            slack = 1e-9 * sums + 1e-300  # far above the product's rounding
            most = self.most
            if len(names) > self.k:  # one of them may be the query's own row
                most = np.minimum(most, np.partition(rough + slack, self.k, axis=1)[:, self.k])
            # what isn't a number is measured exactly too
            q, r = np.nonzero(~(rough - slack > most[:, None]) & (names[None] != self.of[:, None]))
            exact = np.zeros(len(q))
            for c in range(rows.shape[1]):
                difference = rows[r, c] - self.queries[q, c]
                exact += difference * difference
        at, who, near = np.concatenate([self.at, q]), np.concatenate([self.who, names[r]]), np.concatenate([self.near, exact])
        order = np.lexsort((who, near, at))
        at, who, near = at[order], who[order], near[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        kept = rank < self.k
        self.at, self.who, self.near = at[kept], who[kept], near[kept]
        last = np.flatnonzero(rank == self.k - 1)
        self.most[at[last]] = near[last]


def _nearest_of_block(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, distance) for a set of queries that is sent to every task, which keeps k rows a query.

    Vectors that are null or hold a null take no part, nor do those of another length than the query's.
    """
    sent = queries.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter("vec_id IS NOT NULL AND embedding IS NOT NULL").toArrow()
    known = queries.sparkSession.sparkContext.broadcast((sent["vec_id"].to_pylist(), sent["embedding"].to_pylist()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = known.value
        places: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            if None not in v:
                places.setdefault(len(v), []).append(i)
        found = {n: _Nearest(np.array([ids[i] for i in of], dtype=np.int64), np.array([vectors[i] for i in of]).reshape(len(of), n), k) for n, of in places.items()}
        for batch in batches:
            lengths = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for n in set(lengths.tolist()) & set(found):
                part = batch.filter(pa.array(lengths == n))
                values = part.column(1).flatten()
                whole = np.flatnonzero(~values.is_null().to_numpy(zero_copy_only=False).reshape(len(part), n).any(axis=1))
                numbers, names = values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), n)[whole], part.column(0).to_numpy()[whole]
                for low in range(0, len(names), ROWS_AT_ONCE):
                    found[n].take(numbers[low : low + ROWS_AT_ONCE], names[low : low + ROWS_AT_ONCE])
        for one in found.values():
            for low in range(0, len(one.at), 1 << 16):
                piece = slice(low, low + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(one.of[one.at[piece]]), pa.array(one.who[piece]), pa.array(one.near[piece])], ["query_id", "vec_id", "distance"])

    near = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter("vec_id IS NOT NULL AND embedding IS NOT NULL").mapInArrow(run, "query_id bigint, vec_id bigint, distance double")
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_of_each(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, distance) for every query, which are sent to every task in blocks of at most MAX_QUERIES.

    A block is a range of query ids; each is run against all rows.  Only the
    blocks' bounds reach the driver.
    """
    if queries.count() <= MAX_QUERIES:
        return _nearest_of_block(queries, rows, k)
    ranked = global_rank(queries.select("vec_id"), ["vec_id"])
    bounds = [r["vec_id"] for r in ranked.filter((F.col("rn") - 1) % MAX_QUERIES == 0).orderBy("rn").collect()]
    out = None
    for low, high in zip(bounds, [*bounds[1:], None]):
        block = queries.filter(F.col("vec_id") >= low if high is None else (F.col("vec_id") >= low) & (F.col("vec_id") < high))
        hits = _nearest_of_block(block, rows, k)
        out = hits if out is None else out.union(hits)
    return out


def best_per_source(hits: DataFrame, source: str = "source", query: str = "query_id") -> DataFrame:
    """The first hit of each source, in order of distance."""
    order = Window.partitionBy(query, source).orderBy("distance", "vec_id")
    return hits.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def packed_context(hits: DataFrame, query: str, order: str, source: str, text: str, max_chars: int = 6000) -> DataFrame:
    """Snippets in order until the first that doesn't fit; two characters are counted for each separator."""
    snippet = F.trim(F.concat(F.lit("SOURCE: "), F.col(source), F.lit("\n"), F.col(text)))
    window = Window.partitionBy(query).orderBy(order)
    used = hits.withColumn("__s", snippet).withColumn("__before", F.coalesce(F.sum(F.length("__s") + 2).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    over = used.withColumn("__over", F.max((F.col("__before") + F.length("__s") > max_chars).cast("int")).over(window.rowsBetween(Window.unboundedPreceding, 0)))
    kept = over.filter("__over = 0").groupBy(query).agg(F.array_sort(F.collect_list(F.struct(F.col(order), F.col("__s")))).alias("__l"))
    return kept.select(query, F.size("__l").alias("n_hits"), F.array_join(F.transform("__l", lambda x: x["__s"]), "\n\n---\n\n").alias("context"))
