from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rankloom.operators.boards import board_rows
from rankloom.operators.catalog import CATALOG_SCHEMA, catalog_upsert
from rankloom.plans import views as W
from rankloom.streaming import boards as SB
from rankloom.streaming import catalog as SC
from rankloom.streaming import evidence as SE

SCHEMA = "ts TIMESTAMP, scope STRING, item BIGINT, metric BIGINT"


def test_closed_boards_equal_batch_and_late_rows_are_dropped(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(hours=i), "xy"[i % 2], i % 5, i) for i in range(24 * 12)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(source)
    SB.write_daily_totals(stream(), out).awaitTermination()
    # rows for a closed day come too late
    spark.createDataFrame([(start + timedelta(days=2), "x", 1, 10**9)], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    SB.write_daily_totals(stream(), out).awaitTermination()
    capture = date(2024, 1, 10)
    key = lambda r: (r.scope, r.period, r.rank, r["item"], r.metric)
    got = {key(r) for r in SB.closed_boards(spark, out, [capture]).collect()}
    want = {key(r) for r in board_rows(spark.createDataFrame(rows, SCHEMA), [capture]).collect()}
    assert got == want and got


def test_catalog_stream_equals_batches(spark, folder, tmp_path):
    batch = W.Batch(spark, folder)
    source, out = str(tmp_path / "ev"), str(tmp_path / "out")
    schema = batch.current.schema
    for rows in (batch.prior, batch.current):
        rows.coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):  # the second run finds nothing new
            SC.stream_catalog_upsert(spark.readStream.schema(schema).parquet(source), out).awaitTermination()
    got = sorted(map(tuple, SC.catalog_version(spark, f"{out}/catalog").collect()))
    empty = spark.createDataFrame([], CATALOG_SCHEMA)
    want = sorted(map(tuple, catalog_upsert(catalog_upsert(empty, batch.prior), batch.current).collect()))
    assert got == want and got


def state(spark, out):
    return sorted(map(tuple, SC.catalog_version(spark, f"{out}/catalog").collect()))


def files(out):
    return {p: (p.stat().st_mtime_ns, p.read_bytes()) for p in Path(out, "catalog", "entries").rglob("*.parquet")}


def test_upsert_leaves_other_partitions_alone(spark, folder, tmp_path):
    out, batch = str(tmp_path / "out"), W.Batch(spark, folder)
    SC.upsert_into(spark, f"{out}/catalog", batch.prior)
    SC.upsert_into(spark, f"{out}/catalog", batch.current.limit(0))
    before = files(out)
    some = batch.current.where("status = 'accepted'").orderBy("full_name").limit(2)
    touched = {f"bucket={r[0]}" for r in some.select(SC.bucket(F.col("full_name"))).collect()}
    SC.upsert_into(spark, f"{out}/catalog", some)
    after = files(out)
    assert {p: v for p, v in before.items() if p.parent.name not in touched} == {p: v for p, v in after.items() if p.parent.name not in touched}
    assert len(before) > 2 and not {p for p in before if p.parent.name in touched} & set(after)
    want = catalog_upsert(catalog_upsert(spark.createDataFrame([], CATALOG_SCHEMA), batch.prior), some)
    assert state(spark, out) == sorted(map(tuple, want.collect()))


def test_restarted_stream_and_single_batches_agree(spark, folder, tmp_path):
    batch = W.Batch(spark, folder)
    source, out = str(tmp_path / "ev"), str(tmp_path / "out")
    batch.prior.coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema(batch.prior.schema).parquet(source)
    SC.stream_catalog_upsert(stream(), out).awaitTermination()
    SC.upsert_into(spark, f"{out}/catalog", batch.current)
    want = state(spark, out)
    # the checkpoint is lost: everything is replayed, in the order it came in
    batch.current.coalesce(1).write.mode("append").parquet(source)
    query = stream().writeStream.foreachBatch(lambda rows, _: SC.upsert_into(rows.sparkSession, f"{out}/catalog", rows))
    query.option("checkpointLocation", str(tmp_path / "new")).trigger(availableNow=True).start().awaitTermination()
    assert state(spark, out) == want and want


def test_an_upsert_that_broke_off_is_finished(spark, folder, tmp_path, monkeypatch):
    batch = W.Batch(spark, folder)
    out, root = str(tmp_path / "out"), f"{tmp_path}/out/catalog"
    SC.upsert_into(spark, root, batch.prior)
    put = SC._put

    def breaks(spark, folder, path):
        put(spark, folder, path)
        for file in Path(folder, "entries").rglob("*.parquet"):  # partitions that were taken away and not yet replaced
            file.unlink()
        raise RuntimeError("lost")

    monkeypatch.setattr(SC, "_put", breaks)
    with pytest.raises(RuntimeError):
        SC.upsert_into(spark, root, batch.prior.unionByName(batch.current))
    monkeypatch.setattr(SC, "_put", put)
    SC.upsert_into(spark, root, batch.current.limit(0))
    held = {r[0] for r in state(spark, out)}
    assert held >= {r.full_name for r in batch.prior.unionByName(batch.current).where("status = 'accepted'").collect()}


def test_evidence_stream_equals_batch_on_closed_buckets(spark, tmp_path):
    start = datetime(2024, 1, 1)
    schema = "ts TIMESTAMP, full_name STRING, kind STRING, sha256 STRING"
    rows = [(start + timedelta(hours=7 * i), f"a/{i % 2}", "readme", str(i % 3)) for i in range(40)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame(rows, schema)
    df.coalesce(1).write.parquet(source)
    SE.write_deduplicated(spark.readStream.schema(schema).parquet(source), out).awaitTermination()
    last = max(r[0] for r in rows) - timedelta(days=1)
    batch = SE.dedup_evidence(df).where(F.date_add("bucket_day", 1) <= F.lit(last))
    columns = ("bucket_day", "full_name", "kind", "sha256", "first_seen", "copies")
    got = sorted(map(tuple, spark.read.parquet(f"{out}/evidence").select(*columns).collect()))
    assert got == sorted(map(tuple, batch.select(*columns).collect())) and got


def test_live_boards_equal_batch_and_state_is_bounded(spark, tmp_path):
    """Three runs of a stream: open days are current, closed ones final, late rows dropped, falling totals seen."""
    import random

    from rankloom.streaming import live as SL

    rng = random.Random(5)
    start, source, out = datetime(2024, 1, 1), str(tmp_path / "in"), str(tmp_path / "out")
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(source)
    seen, sizes = [], []

    def event(day):
        return (start + timedelta(days=day, seconds=rng.randrange(86400)), rng.choice("xy"), rng.randrange(40), rng.choice([5, 7, 11, -9]))

    batches = [[event(d) for d in (0, 1) for _ in range(150)], [event(d) for d in (1, 2, 3) for _ in range(120)], [event(0) for _ in range(30)] + [event(5) for _ in range(60)]]
    late = batches[2][:30]
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        query = SL.write_live_boards(stream(), out, top=4)
        query.awaitTermination()
        seen += [r for r in rows if r not in late]
        sizes.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress][-1])
        totals = {}
        for ts, scope, item, metric in seen:
            for s in (scope, "global"):
                own = totals.setdefault((ts.date(), s), {}).setdefault(item, [0, 0])
                own[0] += metric
                own[1] += 1
        last = max(ts for ts, *_ in seen).date()
        want = {
            (day, s, item, metric, hits, rank, day < last)
            for (day, s), items in totals.items()
            for rank, (item, (metric, hits)) in enumerate(sorted(items.items(), key=lambda x: (-x[1][0], x[0]))[:4], 1)
        }
        assert {tuple(r) for r in SL.live_boards(spark, out, top=4).collect()} == want
    # rows of packed totals, a list and a timer (which is held twice) for each shard of a scope of an open day, and of no closed one
    assert sizes[-1] <= 3 * SL.SHARDS * (8 + 1 + 2)
