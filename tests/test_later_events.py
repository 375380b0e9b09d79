"""Queries on the newest capture follow the events, whatever their dates."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tools.compare import compare

OFFSET = 100


@pytest.fixture(scope="module")
def later(spark, folder, tmp_path_factory):
    """The tables with a hundred days more: events of the last days again, under other values."""
    out = tmp_path_factory.mktemp("later")
    for table in Path(folder).glob("*.parquet"):
        if table.name != "events.parquet":
            (out / table.name).symlink_to(table)
    events = spark.read.parquet(f"{folder}/events.parquet")
    shift = F.expr(f"ts + INTERVAL {OFFSET} DAYS").alias("ts")
    moved = events.select(*[shift if c == "ts" else (F.col(c) * 2).alias(c) if c == "value" else c for c in events.columns])
    events.unionByName(moved).write.parquet(str(out / "events.parquet"))
    return str(out)


@pytest.mark.parametrize("name", ["trend_board", "momentum_join", "age_days", "pool_counts", "symmetric_difference"])
def test_query(spark, later, name):
    outcome = compare(spark, later, name)
    assert outcome.startswith("ok"), outcome
