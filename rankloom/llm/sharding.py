"""Sharding by a two-pass external shuffle.

Pass one scatters records into buckets of about ``bucket_bytes`` by a seeded hash; pass two puts each
bucket in a canonical order, shuffles it (numpy's ``permutation`` is a Fisher-Yates shuffle) with a
generator seeded by (seed, bucket), and numbers its rows. The buckets' row counts, summed up, turn
those numbers into one gapless position over all records; position ``p`` goes to slot ``p // shards`` of
shard ``p % shards``, so the shards' row counts differ by one at most (law ``rows``).

No bucket depends on a value that many rows share: the hash takes the whole record, so copies of a text, or
a key that a third of the rows hold, spread over all buckets. A repeated task makes the same choice. The
result follows from the seed and the rows alone, whatever the layout of the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.common import bucket_of, parts, total_bytes

SHARDS = 24
BUCKET_BYTES = 16 << 20
SEED = 20240131
#: Bucket counts above this are not broadcast: 16 bytes each, so at most 16 MB are.
BROADCAST_BUCKETS = 1 << 20


def _shuffled(seed: int):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        order = pc.sort_indices(table.select(["key", "tie"]), sort_keys=[("key", "ascending"), ("tie", "ascending")])
        mixed = order.to_numpy()[np.random.default_rng([seed, bucket]).permutation(len(table))]
        rank = pa.array(np.arange(len(table), dtype=np.int64))
        return table.take(pa.array(mixed)).select(["record", "bucket"]).append_column("place", rank)

    return run


def external_shuffle(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
                     bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """All columns of ``df`` as struct ``record``, with ``shard`` (int) and ``slot`` (long).

    Null keys and texts are ordinary values; rows that are equal in all columns are interchangeable and
    each gets a place; an empty table gives an empty result. Columns of ``df`` cannot clash with the
    added ones, since they stay inside the struct."""
    n = parts(total_bytes(df, text) + 8 * df.count(), bucket_bytes)
    every: list[Column] = [F.col(f"record.`{c}`") for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)]
    scattered = (
        df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record"))
        .withColumn("key", F.col(f"record.`{key}`"))
        .withColumn("tie", F.xxhash64(*every))
        .withColumn("bucket", bucket_of(seed, n, "tie"))
    )
    numbers = scattered.groupBy("bucket").agg(F.count("*").alias("rows"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbers.select("bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    schema = T.StructType([scattered.schema["record"], scattered.schema["bucket"], T.StructField("place", T.LongType())])
    placed = scattered.groupBy("bucket").applyInArrow(_shuffled(seed), schema)
    joined = placed.join(F.broadcast(offsets) if n <= BROADCAST_BUCKETS else offsets, "bucket")
    position = F.col("offset") + F.col("place")
    return joined.select(
        "record",
        F.pmod(position, F.lit(shards)).cast("int").alias("shard"),
        F.floor(position / F.lit(shards)).cast("long").alias("slot"),
    )


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Write the shuffled records to ``path``, one folder per shard, rows in slot order within a file."""
    rows = external_shuffle(df, **options)
    shards = options.get("shards", SHARDS)
    by_range = rows.repartitionByRange(max(shards, rows.sparkSession.sparkContext.defaultParallelism), "shard", "slot")
    by_range.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame) -> DataFrame:
    """The query's columns, from the shuffled records."""
    shuffled = external_shuffle(docs.select("doc_id", "text"))
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return shuffled.select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
