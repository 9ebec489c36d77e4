"""Approximate nearest neighbours by multi-index hashing.

Vectors get 64-bit codes: centred, reduced or padded to 64 dimensions, turned
by a rotation learned on a bounded sample (iterative quantization, Gong and
Lazebnik 2011), and cut at zero.  A code is split into eight substrings and
each is indexed.  Of two codes within a Hamming radius r at least one substring
lies within its share of r (pigeonhole), so probing the substrings' buckets
retrieves every code within the radius; those are then ranked by their exact
distance.  The radius is the one that holds 99 of 100 true neighbours within
the sample; in the whole table neighbours are only nearer.

Every vector is indexed.  The table is cut into blocks of vectors and the
queries into blocks of queries; a task searches one block for one block of
queries and returns the nearest of each query, so what a task holds is bounded.

Defined results: vectors that are null, all zero, or hold null or non-finite
components take no part, nor do rows without an id and vectors of another
length than the most common one (of equally common ones the longer).  A row
repeated whole counts once; an id with several vectors has the nearest of them.
A query doesn't find its own id.  Where a radius finds fewer than k, it grows
until k are found or all are.  Equal distances go to the smaller id.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BITS, PARTS = 64, 8
PART_BITS = BITS // PARTS
#: Vectors the rotation is learned on, at most about; queries the radius is taken from.
SAMPLE, SAMPLE_QUERIES = 20_000, 200
#: Share of true neighbours in the sample that the radius holds.
HELD = 0.99
#: Rows of a block.
BLOCK_VECTORS, BLOCK_QUERIES = 16_384, 4_096

_BY_DISTANCE = [np.array([sum(1 << b for b in bits) for bits in combinations(range(PART_BITS), n)], dtype=np.int64) for n in range(PART_BITS + 1)]


class Codes:
    """Centre and rotation from vectors to codes."""

    def __init__(self, sample: np.ndarray, rounds: int = 30, seed: int = 11) -> None:
        self.mean = sample.mean(0)
        centred = sample - self.mean
        _, _, axes = np.linalg.svd(centred, full_matrices=False)
        axes = axes[:BITS].T
        self.project = np.zeros((sample.shape[1], BITS))
        self.project[:, : axes.shape[1]] = axes
        z = centred @ self.project
        turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(BITS, BITS)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(z @ turn > 0, 1.0, -1.0).T @ z)
            turn = (u @ v).T
        self.project = self.project @ turn

    def of(self, vectors: np.ndarray) -> np.ndarray:
        bits = (vectors - self.mean) @ self.project > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


class MultiIndex:
    """Eight tables from substring value to rows."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        parts = codes[:, None] >> (np.arange(PARTS, dtype=np.uint64) * np.uint64(PART_BITS))
        self.parts = (parts & np.uint64((1 << PART_BITS) - 1)).astype(np.int64)
        self.rows = np.argsort(self.parts, axis=0, kind="stable")
        self.starts = np.stack([np.searchsorted(self.parts[self.rows[:, p], p], np.arange((1 << PART_BITS) + 1)) for p in range(PARTS)])

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Rows whose codes are within the radius, all of them."""
        share, rest = divmod(min(radius, BITS), PARTS)
        found = np.zeros(len(self.codes), dtype=bool)
        for p in range(PARTS):
            value = int(code >> np.uint64(p * PART_BITS)) & ((1 << PART_BITS) - 1)
            reach = share if p <= rest else share - 1
            for n in range(min(reach, PART_BITS) + 1):
                for probe in (value ^ _BY_DISTANCE[n]).tolist():
                    found[self.rows[self.starts[p, probe] : self.starts[p, probe + 1], p]] = True
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= radius]


def fit(sample: np.ndarray, k: int) -> tuple[Codes, int]:
    """Codes and the radius that holds HELD of the true k nearest within the sample."""
    codes = Codes(sample)
    if len(sample) <= 2 * k:
        return codes, BITS
    bits = codes.of(sample)
    distances = []
    for at in np.linspace(0, len(sample) - 1, min(SAMPLE_QUERIES, len(sample)), dtype=np.int64):
        d = ((sample - sample[at]) ** 2).sum(1)
        d[at] = np.inf
        near = np.argpartition(d, k)[:k]
        distances.append(np.bitwise_count(bits[near] ^ bits[at]))
    return codes, int(np.quantile(np.concatenate(distances), HELD, method="higher"))


def _valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vectors = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return vectors.filter(F.coalesce(usable, F.lit(False)))


def search(df: DataFrame, k: int = 10, query_modulus: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found of every row whose id is divisible by ``query_modulus``."""
    spark = df.sparkSession
    valid = _valid(df, id_col, vector_col)
    kind = valid.schema["vec_id"].dataType.simpleString()
    sizes = valid.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    rows = valid.filter(F.size("v") == sizes[0]["d"])
    # rounded to the original precision, so equal rows are equal here too
    rows = rows.dropDuplicates(["vec_id", "v"])
    n, parts = sizes[0]["n"], 1_000_000
    share = min(parts, -(-SAMPLE * parts // n))
    sample = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(parts)) < share).orderBy("vec_id").limit(2 * SAMPLE).select("v").toPandas()
    if not len(sample):
        sample = rows.orderBy("vec_id").limit(1000).select("v").toPandas()
    fitted = spark.sparkContext.broadcast(fit(np.stack(sample["v"].to_numpy()), k))
    queries = rows.filter(F.col("vec_id") % query_modulus == 0)
    blocks, query_blocks = -(-n // BLOCK_VECTORS), max(1, -(-n // (query_modulus * BLOCK_QUERIES)))

    def blocked(side: DataFrame, own: str, count: int, other: str, others: int) -> DataFrame:
        side = side.withColumn(own, F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)).cast("int"))
        return side.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    def run(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(q) and len(x):
            codes, radius = fitted.value
            ids, vectors = x["vec_id"].to_numpy(), np.stack(x["v"].to_numpy())
            index = MultiIndex(codes.of(vectors))
            of, asked = np.stack(q["v"].to_numpy()), codes.of(np.stack(q["v"].to_numpy()))
            for at, (query, code) in enumerate(zip(q["vec_id"].to_numpy(), asked)):
                reach = radius
                while True:
                    found = index.within(code, reach)
                    found = found[ids[found] != query]
                    if len(found) >= k or reach >= BITS:
                        break
                    reach = min(BITS, reach + PART_BITS // 2)
                difference = vectors[found] - of[at]
                score = np.sqrt((difference * difference).sum(1))
                order = np.lexsort((ids[found], score))
                # an id may have several vectors: keep its nearest, then the k nearest ids
                _, first = np.unique(ids[found][order], return_index=True)
                order = order[np.sort(first)][:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[found][order], "score": score[order]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    asked = blocked(queries, "qb", query_blocks, "xb", blocks).groupBy("qb", "xb")
    given = blocked(rows, "xb", blocks, "qb", query_blocks).groupBy("qb", "xb")
    found = asked.cogroup(given).applyInPandas(run, f"query_id {kind}, vec_id {kind}, score double")
    nearest = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return nearest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
