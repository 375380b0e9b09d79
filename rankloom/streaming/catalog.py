"""The catalog kept current in place, from a stream of evaluations or from one batch after another.

The catalog is a table of ``BUCKETS`` partitions by a hash of the key. An upsert reads and replaces only the
partitions that hold one of its keys. Replacing partitions is not one step, so the rows are first written beside
the catalog and noted as pending; whoever upserts next puts pending rows in place before anything else. Applying
the same evaluations again changes nothing, and evaluations that are replayed in their order end in the same
catalog, so a repeated micro-batch, a lost checkpoint and single batches in the same folder all agree. There is
one writer at a time; a reader during an upsert may miss partitions that are being replaced.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rankloom.operators.catalog import CATALOG_SCHEMA, catalog_upsert
from rankloom.session import rebalanced, run_folder, stored

#: Fixed for the life of a catalog.
BUCKETS = 64
PENDING = "rows STRING"


def bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def _held(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, f"{folder}/entries", f"{CATALOG_SCHEMA}, bucket INT")


def catalog_version(spark: SparkSession, folder: str) -> DataFrame:
    """The catalog as it is now, empty at first."""
    return _held(spark, folder).drop("bucket")


def _put(spark: SparkSession, folder: str, path: str) -> None:
    """Replace the partitions of the rows below ``path``; again if need be."""
    rows = spark.read.schema(f"{CATALOG_SCHEMA}, bucket INT").parquet(path)
    target = rebalanced(rows, "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    target.partitionBy("bucket").parquet(f"{folder}/entries")


def _note(spark: SparkSession, folder: str, paths: list[str]) -> None:
    spark.createDataFrame([(p,) for p in paths], PENDING).coalesce(1).write.mode("overwrite").parquet(f"{folder}/pending")


def finish_pending(spark: SparkSession, folder: str) -> None:
    """Put in place what an upsert that broke off had written."""
    for row in _read(spark, f"{folder}/pending", PENDING).collect():
        _put(spark, folder, row["rows"])


def upsert_into(spark: SparkSession, folder: str, evaluations: DataFrame) -> None:
    """Merge accepted evaluations into the catalog below ``folder``; other partitions are neither read nor written."""
    finish_pending(spark, folder)
    fresh = stored(evaluations.where(F.col("status") == "accepted").withColumn("bucket", bucket(F.col("full_name"))), "catalog-fresh")
    touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most BUCKETS
    if not touched:
        return
    held = _held(spark, folder).where(F.col("bucket").isin(touched)).drop("bucket")
    merged = catalog_upsert(held, fresh.drop("bucket"))
    path = run_folder(spark, "catalog-rows")
    merged.withColumn("bucket", bucket(F.col("full_name"))).write.parquet(path)
    _note(spark, folder, [path])
    _put(spark, folder, path)
    _note(spark, folder, [])


def stream_catalog_upsert(evaluations: DataFrame, folder: str) -> StreamingQuery:
    """Upsert each micro-batch of evaluations into the catalog below ``folder``."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_into(batch.sparkSession, f"{folder}/catalog", batch)

    return (
        evaluations.writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
