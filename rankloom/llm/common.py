"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def total_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a column over all rows: the figure from which group counts follow."""
    return int(df.select(F.sum(F.octet_length(column)).alias("b")).first()["b"] or 0)


def parts(total: int, each: int) -> int:
    """How many parts of about ``each`` bytes ``total`` bytes make."""
    return max(1, -(-total // each))


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs of consecutive items of at most ``limit`` bytes together (one item may be larger)."""
    start = total = 0
    for k, size in enumerate(sizes):
        if k > start and total + size > limit:
            yield start, k
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """Start, end and texts of runs of rows of at most ``limit`` bytes together; only one run at a time is copied from the column."""
    for a, z in slices(pc.fill_null(pc.binary_length(column), 0).to_pylist(), limit):
        yield a, z, text_bytes(column.slice(a, z - a))


def bucket_of(seed: int, n: int, *columns: Column | str) -> Column:
    """A seeded hash of the columns, spread over ``n`` buckets."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in columns]), F.lit(n))
