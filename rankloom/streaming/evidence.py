"""Freshness-bounded deduplication of an evidence stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rankloom.sources.batches import write_dated


def dedup_evidence(records: DataFrame, bucket: str = "1 day", delay: str = "1 day") -> DataFrame:
    """One record per (key, kind, sha256) and freshness bucket, the earliest time kept.

    Works on a batch and on a stream; on a stream the state of a bucket ends with the
    watermark, so it does not grow with the stream's age.
    """
    source = records.withWatermark("ts", delay) if records.isStreaming else records
    return (
        source.groupBy(F.window("ts", bucket), "full_name", "kind", "sha256")
        .agg(F.min("ts").alias("first_seen"), F.count("*").alias("copies"))
        .select(F.to_date("window.start").alias("bucket_day"), "full_name", "kind", "sha256", "first_seen", "copies")
    )


def write_deduplicated(records: DataFrame, folder: str) -> StreamingQuery:
    def sink(batch: DataFrame, batch_id: int) -> None:
        write_dated(batch, f"{folder}/evidence", "bucket_day")

    return (
        dedup_evidence(records)
        .writeStream.outputMode("append")
        .foreachBatch(sink)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
