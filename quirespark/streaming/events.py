"""Windowed counts and first-writer-wins over a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hourly(events: DataFrame) -> DataFrame:
    """``event_type, window_start, events, total`` by hour; works on tables and on streams with a watermark."""
    out = events.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 4).alias("total"))
    return out.select("event_type", F.col("w.start").alias("window_start"), "events", "total")


def read_stream(spark: SparkSession, folder: str, schema, late: str = "2 hours") -> DataFrame:
    """A folder of Parquet files as a stream; rows later than ``late`` are dropped by stateful operators."""
    return spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def first_results(stream: DataFrame, keys: list[str], time: str = "finished_at", late: str = "2 hours") -> DataFrame:
    """The first row of each key within the watermark: the memory of translations as a stream."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
