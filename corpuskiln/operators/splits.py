"""Buckets, statistics, leak-free splits, samples and the small relational steps around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42


def _everything() -> Window:
    return Window.partitionBy(F.lit(0))


def global_rank(df: DataFrame, keys: Sequence[str], out: str = "rn") -> DataFrame:
    """1-based rank over the whole table by ``keys`` without one task that sees it all.

    Rows are range-partitioned and sorted, the ranges' sizes are summed on the
    driver (a number a partition), and each row adds its place in its range.
    """
    ranges = df.repartitionByRange(*[F.col(k) for k in keys]).withColumn("__part", F.spark_partition_id())
    ranges = ranges.persist()
    sizes = sorted((r["__part"], r["count"]) for r in ranges.groupBy("__part").count().collect())
    before, run = {}, 0
    for part, n in sizes:
        before[part], run = run, run + n
    offset = F.create_map(*[F.lit(v) for p, b in before.items() for v in (p, b)]) if before else F.create_map(F.lit(0), F.lit(0))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*keys))
    return ranges.withColumn(out, (place + F.element_at(offset, F.col("__part"))).cast("long")).withColumn("__n", F.lit(run).cast("long")).drop("__part")


def quantile_buckets(df: DataFrame, value: str, order: str, buckets: int = 5, out: str = "bucket") -> DataFrame:
    """Equal-frequency buckets '1'.. of the first-come rank, cut at linearly interpolated quantiles."""
    ranked = global_rank(df, [value, order])
    at = F.ceil((F.col("rn") - 1) * buckets / F.greatest(F.col("__n") - 1, F.lit(1)))
    return ranked.withColumn(out, F.least(F.lit(buckets), F.greatest(F.lit(1), at)).cast("string")).drop("rn", "__n")


def pearson(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, correlation) with the target, one aggregation for all columns."""
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return row.selectExpr(f"stack({len(columns)}, {pairs}) AS (column, correlation)")


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``rank_<column>``: ties share the mean of their ranks, from counts of values."""
    for c in columns:
        counts = df.groupBy(F.col(c).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
        ranks = global_rank_of_counts(counts)
        df = df.join(ranks, F.col(c) == F.col("__v"), "left").withColumn(f"rank_{c}", F.col("__rank")).drop("__v", "__rank")
    return df


def global_rank_of_counts(counts: DataFrame) -> DataFrame:
    """(__v, __rank) with the mean rank of each distinct value, by running totals over ranges."""
    ranges = counts.filter("__v IS NOT NULL").repartitionByRange("__v").withColumn("__part", F.spark_partition_id()).persist()
    sizes = sorted((r["__part"], r["n"]) for r in ranges.groupBy("__part").agg(F.sum("__c").alias("n")).collect())
    before, run = {}, 0
    for part, n in sizes:
        before[part], run = run, run + n
    offset = F.create_map(*[F.lit(v) for p, b in before.items() for v in (p, b)]) if before else F.create_map(F.lit(0), F.lit(0))
    up_to = F.sum("__c").over(Window.partitionBy("__part").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    return ranges.select("__v", (F.element_at(offset, F.col("__part")) + up_to - (F.col("__c") - 1) / 2).alias("__rank"))


def spearman(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    ranked = average_ranks(df, [*columns, target])
    named = ranked.select(*[F.col(f"rank_{c}").alias(c) for c in [*columns, target]])
    return pearson(named, columns, target)


def group_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    v = F.col(value)
    return df.groupBy(by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.stddev_samp(v).alias("std"))


def dominance(most: Column, total: Column) -> Column:
    return F.when(total > 0, most / F.when(total > 0, total))


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Counts of values with their percentage; a null isn't a value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(_everything()))


def first_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key by ``order``, with a map-side combine."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(*[F.min_by(c, F.col(order)).alias(c) for c in rest])


def split_digest(key: Column, seed: int = SEED) -> Column:
    """The hash that a group's place within its stratum follows."""
    return F.sha1(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def stratified_split(groups: DataFrame, key: str, stratum: str, shares: Sequence[tuple[str, float]] = (("train", 0.8), ("val", 0.1), ("test", 0.1)), seed: int = SEED) -> DataFrame:
    """``split`` of each group: strata are ordered by a hash of seed and key and cut at cumulated shares.

    Within a stratum of n groups the first round(0.8 n) are train, and so on.
    """
    window = Window.partitionBy(stratum).orderBy("__digest", key)
    ranked = groups.withColumn("__digest", split_digest(F.col(key), seed)).withColumn("__rn", F.row_number().over(window)).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(stratum)))
    cut, out = 0.0, F.lit(shares[-1][0])
    branches = []
    for name, share in shares[:-1]:
        cut += share
        branches.append((name, F.floor(F.col("__n") * F.lit(cut) + 0.5)))
    for name, bound in reversed(branches):
        out = F.when(F.col("__rn") <= bound, name).otherwise(out)
    return ranked.withColumn("split", out).drop("__digest", "__rn", "__n")


def inherit_split(files: DataFrame, split: DataFrame, key: str) -> DataFrame:
    """Derived files take their source's split; without one it's null."""
    return files.join(split.select(key, "split"), key, "left")


def split_pivot(df: DataFrame, rows: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``column``'s values by ``rows``, empty cells 0, with row totals."""
    out = df.groupBy(rows).pivot(column, list(values)).count().na.fill(0, list(values))
    return out.withColumn("total", sum((F.col(v) for v in values), F.lit(0)))


def holdout(new: DataFrame, known: DataFrame, key: str, share: float = 0.05, seed: int = SEED) -> DataFrame:
    """Keys seen before keep their ``set``; of new ones about ``share`` become holdout by a hash."""
    joined = new.join(known.select(key, F.col("set").alias("__set")), key, "left")
    draw = F.conv(F.substring(split_digest(F.col(key), seed), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    return joined.withColumn("set", F.coalesce("__set", F.when(draw < share, "holdout").otherwise("train"))).drop("__set")


def label_sets(df: DataFrame, key: str, sets: Sequence[tuple[str, DataFrame]], default: str | None = None) -> DataFrame:
    """Label by membership; of several sets the later one wins."""
    marks = []
    for i, (_, members) in enumerate(sets):
        df = df.join(members.select(F.col(key)).distinct().withColumn(f"__in{i}", F.lit(True)), key, "left")
        marks.append(f"__in{i}")
    label = F.lit(default)
    for (name, _), mark in zip(sets, marks):
        label = F.when(F.col(mark), name).otherwise(label)
    return df.withColumn("set", label).drop(*marks)


def not_in_set(df: DataFrame, name: str, column: str = "set") -> DataFrame:
    """Rows of other sets; a null set stays."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(name)))


def totals_by(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    sums = df.groupBy(*by).agg(F.sum(value).alias("total"))
    return sums.withColumn("percent", F.col("total") * 100.0 / F.sum("total").over(_everything()))


def join_one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that adds only missing columns and fails if a key repeats on either side.

    The check is part of the plan: a repeated key raises when its row is made.
    """
    def once(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(f"__{side}"), *[F.first(c).alias(c) for c in df.columns if c != key])

    new = right.select(key, *[c for c in right.columns if c not in left.columns])
    both = once(left, "l").join(once(new, "r"), key, "left")
    unique = (F.col("__l") == 1) & (F.coalesce("__r", F.lit(1)) == 1)
    checked = F.when(unique, F.col(key)).otherwise(F.raise_error(F.concat(F.lit("key isn't unique: "), F.col(key).cast("string"))).cast(left.schema[key].dataType))
    return both.withColumn(key, checked).drop("__l", "__r")


def concat_rows(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """``n`` rows, the first by a hash of seed and key."""
    return df.orderBy(split_digest(F.col(key), seed), key).limit(n)


def recode_filetype(c: Column) -> Column:
    return F.when(c == "cry", "cryptol").when(c == "saw", "saw").otherwise("text")


def fill_zero(df: DataFrame) -> DataFrame:
    return df.na.fill(0)
