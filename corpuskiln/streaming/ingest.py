"""Structured Streaming extension: new files into a keyed table, exact dedup within a watermark, windowed counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuskiln.operators.keyed import write_keyed


def json_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def parquet_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def dedup_within(stream: DataFrame, key: str, time: str, watermark: str = "1 hour") -> DataFrame:
    """The first row of a key within the watermark; state beyond it is dropped."""
    return stream.withWatermark(time, watermark).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 hour", slide: str | None = None, watermark: str = "2 hours") -> DataFrame:
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return stream.withWatermark(time, watermark).groupBy(window.alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select("w.start", "w.end", by, "n")


def ingest(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], overwrite_existing: bool = False) -> StreamingQuery:
    """Append or upsert every micro-batch by key; repeats within a batch are reduced to one."""

    def one(batch: DataFrame, _: int) -> None:
        write_keyed(batch.dropDuplicates(list(keys)), path, keys, overwrite_existing)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
