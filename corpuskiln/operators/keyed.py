"""Keyed tables: append without repeats, upsert, last-write-wins caches and providers behind them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _need(df: DataFrame, keys: Sequence[str]) -> None:
    if missing := [k for k in keys if k not in df.columns]:
        raise ValueError(f"key columns are missing: {missing}")


def append_new(stored: DataFrame, incoming: DataFrame, keys: Sequence[str] = ("filename", "scenario")) -> DataFrame:
    """Stored rows and the incoming ones whose key isn't stored; repeats within the batch stay."""
    _need(incoming, keys)
    return stored.unionByName(incoming.join(stored.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str] = ("filename", "scenario")) -> DataFrame:
    """Incoming rows take the place of stored ones with their key."""
    _need(incoming, keys)
    return stored.join(incoming.select(*keys).distinct(), list(keys), "left_anti").unionByName(incoming, allowMissingColumns=True)


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _hadoop(spark, path)
    return bool(fs.exists(place))


def write_keyed(incoming: DataFrame, path: str, keys: Sequence[str] = ("filename", "scenario"), overwrite_existing: bool = False) -> None:
    """Append or upsert into a folder of JSON lines; an upsert is written beside and renamed."""
    spark = incoming.sparkSession
    _need(incoming, keys)
    if not exists(spark, path):
        incoming.write.option("ignoreNullFields", "false").json(path)
        return
    stored = spark.read.schema(incoming.schema).json(path)
    if not overwrite_existing:
        incoming.join(stored.select(*keys).distinct(), list(keys), "left_anti").write.mode("append").option("ignoreNullFields", "false").json(path)
        return
    beside = f"{path}.{uuid.uuid4().hex}"
    upsert(stored, incoming, keys).write.option("ignoreNullFields", "false").json(beside)
    fs, old = _hadoop(spark, path)
    _, new = _hadoop(spark, beside)
    fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"could not move {beside} to {path}")


def last_writes(log: DataFrame, key: str = "key", value: str = "value", order: str = "ts") -> DataFrame:
    """The latest value of each key of an append-only log."""
    return log.groupBy(key).agg(F.max_by(value, order).alias(value))


def misses(requests: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """Requests whose key isn't cached; a cached false counts as a miss."""
    hits = cache.filter("value IS NOT NULL AND value <> 'false'").select(key)
    return requests.join(hits, key, "left_anti")


Provider = Callable[[pd.DataFrame], Sequence[str]]


def call_cached(requests: DataFrame, cache_path: str, provider: Provider, key: str = "key", batch: int = 64) -> DataFrame:
    """Requests with ``value`` from a Parquet cache, or from ``provider`` where it has none.

    Each missing key is asked for once, in batches; answers are appended before
    they are used, so a rerun asks only for what is left.
    """
    spark = requests.sparkSession
    schema = f"{key} string, value string, ts timestamp"
    log = spark.read.schema(schema).parquet(cache_path) if exists(spark, cache_path) else spark.createDataFrame([], schema)
    missing = misses(requests, last_writes(log, key), key).dropDuplicates([key])

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                yield pd.DataFrame({key: part[key], "value": list(provider(part))})

    answers = missing.mapInPandas(run, f"{key} string, value string").withColumn("ts", F.current_timestamp())
    answers.write.mode("append").parquet(cache_path)
    return requests.join(last_writes(spark.read.schema(schema).parquet(cache_path), key), key, "left")


def request_key(*parts: Column) -> Column:
    """Cache key of a request: its parts and a hash of what was asked."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"), 256)


def resume(jobs: DataFrame, finished: DataFrame, key: str = "filename") -> DataFrame:
    """Jobs that aren't finished."""
    return jobs.join(finished.filter(F.col(key).isNotNull()).select(key), key, "left_anti")
