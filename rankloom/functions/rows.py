"""Row-producing helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array: Column, name: str, *keep: str | Column, position: str | None = None) -> DataFrame:
    """One row per non-null item of a computed array; 1-based ``position`` on request.

    A plain ``explode`` makes the optimizer add a size filter on the array below it, which
    computes the array a second time; the outer form does not.
    """
    if position:
        rows = df.select(*keep, F.posexplode_outer(array).alias("_p", name))
        rows = rows.withColumn(position, F.col("_p") + 1).drop("_p")
    else:
        rows = df.select(*keep, F.explode_outer(array).alias(name))
    return rows.where(F.col(name).isNotNull())


def join_null_safe(left: DataFrame, right: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """Left join by equal columns in which null equals null; ``right`` is unique by them."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = None
    for c in on:
        equal = left[c].eqNullSafe(renamed[f"_right_{c}"])
        same = equal if same is None else same & equal
    return left.join(renamed, same, "left").drop(*[f"_right_{c}" for c in on])
