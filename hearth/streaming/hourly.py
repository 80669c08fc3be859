"""Hourly prediction-log summary, as a batch query and as a stream.

The log table has (timestamp, prediction, segment...) rows.  The batch form is
a tumbling-window aggregate; the streaming form reads the same files with
Structured Streaming.  Each micro-batch is aggregated and written as partial
sums under its batch number (a repeated batch replaces its own output), and the
summary merges the partial sums per window.  Nothing is held as state and no row
is late: files may come in any order, open hours show what has come so far, and
a later run on the same folder goes on where the last one ended.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hourly_summary(df: DataFrame, ts: str = "ts", value: str = "value",
                   by: Sequence[str] = ("event_type",), width: str = "1 hour") -> DataFrame:
    g = df.groupBy(F.window(ts, width).alias("w"), *by).agg(
        F.count("*").alias("requests"), F.avg(value).alias("mean_prediction"),
        F.min(value).alias("min_prediction"), F.max(value).alias("max_prediction"))
    return g.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), *by,
                    "requests", "mean_prediction", "min_prediction", "max_prediction")


def _keys(ts: str, by: Sequence[str], width: str) -> list:
    return [F.window(ts, width).getField("start").alias("start"), *by]


def hourly_stream(spark: SparkSession, path: str, schema, folder: str, ts: str = "ts", value: str = "value",
                  by: Sequence[str] = ("event_type",), width: str = "1 hour",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Takes in the files at ``path`` that ``folder`` hasn't seen (availableNow) and
    returns the summary of all that it has.  ``folder`` is shared storage that the
    caller names and keeps between runs."""
    parts = os.path.join(folder, "partial")

    def store(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy(*_keys(ts, by, width)).agg(
            F.count("*").alias("n"), F.count(value).alias("known"), F.sum(value).alias("total"),
            F.min(value).alias("low"), F.max(value).alias("high"))
        sums.write.mode("overwrite").parquet(os.path.join(parts, f"batch={number}"))

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))
    q = (events.writeStream.foreachBatch(store).option("checkpointLocation", os.path.join(folder, "state"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    merged = spark.read.parquet(parts).groupBy("start", *by).agg(
        F.sum("n").alias("requests"), F.try_divide(F.sum("total"), F.sum("known")).alias("mean_prediction"),
        F.min("low").alias("min_prediction"), F.max("high").alias("max_prediction"))
    return merged.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), *by,
                         "requests", "mean_prediction", "min_prediction", "max_prediction")
