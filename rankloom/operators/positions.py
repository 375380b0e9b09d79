"""Global positions without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.session import cut_lineage


def with_position(
    df: DataFrame, order: list[Column], by: tuple[str, ...] = (), name: str = "position", partitions: int | None = None
) -> DataFrame:
    """Add the 1-based position of each row in ``order``, counted per ``by`` group.

    Rows are range-partitioned and sorted where they land; each row then knows its place in
    its partition, and the partitions' sizes give the offsets. Groups of any size, even one
    group with all rows, spread over all partitions. The order must be total. The sorted
    rows are cut to the shared checkpoint folder, because both uses must see one and the
    same partitioning.
    """
    keys = [F.col(c) for c in by] + order
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = cut_lineage(
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
    )
    # one row per (partition, group): a group that spans k partitions has k rows here
    sizes = sorted_rows.groupBy("_part", *by).agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    if by:
        # null is a group like any other
        same = sorted_rows["_part"] == offsets["_part"]
        for column in by:
            same = same & sorted_rows[column].eqNullSafe(offsets[column])
        joined = sorted_rows.join(offsets, same).select(sorted_rows["*"], "_offset", "_first")
    else:
        # without groups there is one row per partition, so this side is at most n rows
        joined = sorted_rows.join(F.broadcast(offsets), ["_part"])
    position = F.col("_offset") + F.col("_row") - F.col("_first") + 1
    return joined.withColumn(name, position.cast("bigint")).drop("_part", "_row", "_offset", "_first")
