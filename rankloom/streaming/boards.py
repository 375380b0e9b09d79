"""Boards from an event stream.

The stream keeps state for one day's totals only; closed days are written to a dated table,
and the 1/7/30-day boards are read from that table with the batch operator. Sliding windows
in the stream would hold every event in up to 30 open windows instead.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rankloom.operators.boards import board_totals, rank_boards
from rankloom.sources.batches import write_dated


def daily_stream(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Closed daily totals of a stream (ts, scope, item, metric); later rows are dropped."""
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 day"), "scope", "item")
        .agg(F.sum("metric").alias("metric"), F.count("*").alias("hits"))
        .select(F.to_date("window.start").alias("day"), "scope", "item", "metric", "hits")
    )


def write_daily_totals(events: DataFrame, folder: str, delay: str = "1 day") -> StreamingQuery:
    """Append closed days to ``folder/daily``. A day closes as a whole, in one micro-batch, so
    replacing its partition makes a repeated micro-batch harmless."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_dated(batch, f"{folder}/daily", "day")

    return (
        daily_stream(events, delay)
        .writeStream.outputMode("append")
        .foreachBatch(sink)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def closed_boards(spark: SparkSession, folder: str, captures: list[date], top: int = 25) -> DataFrame:
    """Boards over the closed days; the date filter prunes partitions."""
    daily = spark.read.schema("day DATE, scope STRING, item BIGINT, metric BIGINT, hits BIGINT").parquet(f"{folder}/daily")
    return rank_boards(board_totals(daily, captures), top)
