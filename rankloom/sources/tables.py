"""Reading the warehouse tables: explicit timestamps, column pruning left to the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table; zone-less timestamps become instants in the session zone."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampNTZType):
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp"))
    return df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores when the scan has fewer tasks than cores (few or unsplittable files).

    A scan of many files is left as it is, so large inputs are not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files below ``folder`` as (path relative to it, size, modified, content)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    root = folder.rstrip("/")
    relative = F.regexp_extract(F.col("path"), r"^.*?\Q" + root + r"\E/(.*)$", 1)
    return files.load(root).select(
        relative.alias("path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified_at"),
        "content",
    )
