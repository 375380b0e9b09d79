import json
from datetime import date
from pathlib import Path

import pytest
from fixtures import FRESH, KNOWN
from pyspark.sql import functions as F
from test_sources import batch

from rankloom.plans.daily import audit, ingest
from rankloom.streaming.catalog import catalog_version


def publish(spark, tmp_path, payload, name="b"):
    path = tmp_path / f"{name}.json"
    path.write_text(json.dumps(payload, ensure_ascii=False))
    return ingest(spark, str(path), str(tmp_path / "out")).first()


def state(spark, tmp_path):
    return sorted(map(tuple, catalog_version(spark, str(tmp_path / "out" / "catalog")).collect()))


def test_publish_and_publish_again(spark, tmp_path):
    stats = publish(spark, tmp_path, batch())
    counts = ("pages", "raw_candidates", "evaluated", "accepted", "rejected", "newly_accepted", "catalog_entries")
    assert tuple(stats[c] for c in counts) == (21, 2, 2, 1, 1, 1, 1)
    out = str(tmp_path / "out")
    (shown,) = spark.read.parquet(f"{out}/reports").collect()
    assert (shown.period, shown.full_name, shown.grade, shown.final_score, shown.period_stars) == ("daily", FRESH, "A", 82.55, "132")
    (left,) = spark.read.parquet(f"{out}/rejections").collect()
    assert (left.full_name, left.rejection_stage) == (KNOWN, "trend")
    assert audit(spark, out).count() == 0
    # a published file is changed
    changed = sorted(Path(out, "rejections").rglob("*.parquet"))[0]
    kept = {p: p.read_bytes() for p in (changed, *Path(out).rglob(".*.crc"))}
    spark.read.parquet(str(changed)).coalesce(1).withColumn("more", F.lit(1)).write.parquet(str(tmp_path / "other"))
    changed.write_bytes(sorted((tmp_path / "other").glob("*.parquet"))[0].read_bytes())
    changed.with_name(f".{changed.name}.crc").unlink()
    assert [(r.check, r["item"]) for r in audit(spark, out).collect()] == [("committed file changed", str(changed.relative_to(out)))]
    for path, data in kept.items():
        path.write_bytes(data)
    assert audit(spark, out).count() == 0
    once = state(spark, tmp_path)
    again = publish(spark, tmp_path, batch())
    assert tuple(again[c] for c in counts) == tuple(stats[c] for c in counts)
    assert state(spark, tmp_path) == once
    later = batch()
    later["capture_date"] = "2026-08-28"
    third = publish(spark, tmp_path, later, "later")
    assert (third.accepted, third.newly_accepted, third.catalog_entries) == (1, 0, 1)
    assert spark.read.parquet(f"{out}/editions").select("capture_date").distinct().count() == 2
    assert [r.first_accepted for r in catalog_version(spark, f"{out}/catalog").collect()] == [date(2026, 8, 27)]


def without_repository(b):
    b["repositories"].pop()


def without_page(b):
    b["pages"].pop()


def repeated_features(b):
    b["repositories"][1]["card"]["features"] = b["repositories"][0]["card"]["features"]


def wrong_count(b):
    b["candidate_pool"]["raw_candidate_count"] = 3


@pytest.mark.parametrize(
    "change,message",
    [(without_repository, "pool lighthouse/lamplog: missing"), (without_page, "matrix rust monthly: missing"),
     (repeated_features, "features_repeated"), (wrong_count, "pool counts: mismatch")],
)
def test_faulty_batches_publish_nothing(spark, tmp_path, change, message):
    payload = batch()
    change(payload)
    with pytest.raises(ValueError, match=message):
        publish(spark, tmp_path, payload)
    assert not (tmp_path / "out").exists()
