"""Boards of days that are still open, kept current by keyed state.

A state holds one day of one scope, for a share of its items: ``SHARDS`` states share a scope, so a scope with most
of the events is worked on by as many tasks. It has a total per item and the list of its top items. A micro-batch
adds to the totals of the items it has (a few rows of packed totals are read and written for them), and the list is
made anew from the old list and these items alone; only a total that falls (a negative metric) makes it look through all items. A timer at the end of the day, as the
watermark tells it, writes the list for good and clears the state, so state is bounded by the items of open days.

A day is open until an event two days later is seen (with the delay of a day). Rows of a closed day are dropped.
The lists lie in a table by day and micro-batch; of each state the newest one counts, and the one that the timer wrote above
all. A repeated micro-batch replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from rankloom.sources.batches import write_dated

SHARDS = 8
ROWS = "day DATE, scope STRING, shard INT, item BIGINT, metric BIGINT, hits BIGINT, closed BOOLEAN"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


Totals = dict[int, list[int]]  # item: metric, hits


def _unpacked(value: Any) -> Totals:
    return {i: [m, h] for i, m, h in zip(*value)}


def _packed(totals: Totals) -> tuple:
    return list(totals), [t[0] for t in totals.values()], [t[1] for t in totals.values()]


def slot_of(item: int) -> int:
    """Items that share a slot share a row of the state, so that a micro-batch asks for few rows."""
    return (item * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 61


class TopItems(StatefulProcessor):
    """Totals of a day's items in one shard of a scope, and the list of the ``top`` ones."""

    def __init__(self, top: int):
        self.top = top

    def init(self, handle: StatefulProcessorHandle) -> None:
        packed = "items ARRAY<BIGINT>, metrics ARRAY<BIGINT>, hits ARRAY<BIGINT>"
        self.handle = handle
        self.totals = handle.getMapState("totals", "slot INT", packed)
        self.listed = handle.getValueState("listed", packed)

    def close(self) -> None:
        pass

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        added: Totals = {}
        for frame in rows:
            sums = frame.groupby("item").agg(metric=("metric", "sum"), hits=("hits", "sum"))
            for item, metric, hits in zip(sums.index.tolist(), sums["metric"].tolist(), sums["hits"].tolist()):
                own = added.setdefault(item, [0, 0])
                own[0] += metric
                own[1] += hits
        known = self.listed.exists()
        candidates = _unpacked(self.listed.get()) if known else {}
        if not known:
            day_end = pd.Timestamp(key[0]).tz_localize("UTC") + pd.Timedelta(days=1)
            self.handle.registerTimer(int(day_end.timestamp() * 1000))
        by_slot: dict[int, Totals] = {}
        for item, own in added.items():
            by_slot.setdefault(slot_of(item), {})[item] = own
        for slot, own in by_slot.items():
            held = _unpacked(self.totals.getValue((slot,))) if known and self.totals.containsKey((slot,)) else {}
            for item, (metric, hits) in own.items():
                total = held.setdefault(item, [0, 0])
                total[0] += metric
                total[1] += hits
                candidates[item] = total
            self.totals.updateValue((slot,), _packed(held))
        if any(metric < 0 for metric, _ in added.values()):
            candidates = {i: t for _, value in self.totals.iterator() for i, t in _unpacked(value).items()}
        best = sorted(candidates, key=lambda i: (-candidates[i][0], i))[: self.top]
        self.listed.update(_packed({i: candidates[i] for i in best}))
        yield self.rows(key, [(i, *candidates[i]) for i in best], False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        last = [(i, *t) for i, t in _unpacked(self.listed.get()).items()] if self.listed.exists() else []
        self.totals.clear()
        self.listed.clear()
        yield self.rows(key, last, True)

    @staticmethod
    def rows(key: Any, items: list[tuple], closed: bool) -> pd.DataFrame:
        out = pd.DataFrame(items, columns=["item", "metric", "hits"])
        out.insert(0, "day", key[0])
        out.insert(1, "scope", key[1])
        out.insert(2, "shard", key[2])
        out["closed"] = closed
        return out


def top_lists(events: DataFrame, top: int = 25, delay: str = "1 day") -> DataFrame:
    """The lists that a stream of events (ts, scope, item, metric) changes, each whole. Events without an item, a scope or
    a time are on no board."""
    spread = events.dropna(subset=["ts", "scope", "item", "metric"]).withColumn("scope", F.explode(F.array(F.lit("global"), F.col("scope"))))
    day = F.to_date("ts")
    # the day's end is the event time: all rows of an open day count, however late within it
    closes = F.date_add(day, 1).cast("timestamp")
    keyed = spread.select(
        closes.alias("closes"), day.alias("day"), "scope", F.pmod(F.xxhash64("item"), F.lit(SHARDS)).cast("int").alias("shard"), "item", "metric", F.lit(1).cast("long").alias("hits")
    )
    watched = keyed.withWatermark("closes", delay)
    return watched.groupBy("day", "scope", "shard").transformWithStateInPandas(TopItems(top), ROWS, "Update", "EventTime")


def write_live_boards(events: DataFrame, folder: str, top: int = 25, delay: str = "1 day") -> StreamingQuery:
    """Keep ``folder/live`` current. The state store must be one that can hold lists and maps, so it is set here."""
    spark = events.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        # one use of the batch: each use runs the state anew
        rows = batch.withColumns({"batch": F.lit(batch_id), "written": F.current_timestamp()})
        write_dated(rows, f"{folder}/live", "day", "closed", "batch")

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        writer = top_lists(events, top, delay).writeStream.outputMode("update").foreachBatch(sink)
        return writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    finally:
        spark.conf.set(STATE_STORE, before)


def live_boards(spark: SparkSession, folder: str, top: int = 25) -> DataFrame:
    """(day, scope, item, metric, hits, rank, closed): today's boards as of the last micro-batch, and those of closed days."""
    lists = spark.read.schema(f"{ROWS}, written TIMESTAMP, batch LONG").parquet(f"{folder}/live")
    newest = Window.partitionBy("day", "scope", "shard").orderBy(F.desc("closed"), F.desc("written"))
    current = lists.withColumn("age", F.rank().over(newest)).where("age = 1")
    board = Window.partitionBy("day", "scope").orderBy(F.desc("metric"), "item")
    ranked = current.withColumn("rank", F.row_number().over(board)).where(F.col("rank") <= top)
    return ranked.select("day", "scope", "item", "metric", "hits", "rank", "closed")
