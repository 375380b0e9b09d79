import json
from datetime import date

from fixtures import KNOWN, full_matrix, repository
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.operators import manifests as M
from rankloom.sources import batches as S
from rankloom.sources.tables import read_files

DAY = date(2026, 8, 27)


def batch():
    pages = {}
    for e in full_matrix(DAY):
        page = pages.setdefault((e["scope"], e["period"]), {
            "scope": e["scope"], "period": e["period"], "spoken_language": "any", "source_url": e["source_url"],
            "captured_at": e["captured_at"], "raw_sha256": e["raw_sha256"], "status": "success", "entries": [],
        })
        page["entries"].append({k: e[k] for k in S.ALLOWED_FIELDS["entry"]})
    return {
        "schema_version": 4, "capture_date": DAY.isoformat(), "captured_at": "2026-08-27T10:00:00+08:00",
        "candidate_pool": {"description": "boards", "dedupe_key": "full_name", "raw_candidate_count": 2, "evaluated_candidate_count": 2},
        "pages": list(pages.values()), "repositories": [repository(), repository(KNOWN)],
    }


def conformance(spark, payload):
    df = spark.createDataFrame([("d", payload if isinstance(payload, str) else json.dumps(payload, ensure_ascii=False))], "doc STRING, text STRING")
    rows = S.schema_conformance(df).where(F.size("violations") > 0).collect()
    return {(r.object, v) for r in rows for v in r.violations}


def test_batch_file(spark, tmp_path):
    (tmp_path / "2026-08-27.json").write_text(json.dumps(batch(), ensure_ascii=False, indent=1))
    (tmp_path / "broken.json").write_text("{nope")
    df = S.read_batch(spark, str(tmp_path))
    assert [r["capture_date"] for r in df.collect() if r["_corrupt"]] == [None]
    rows = S.batch_entries(df)
    assert rows.count() == 42 and rows.select("scope", "period").distinct().count() == 21
    repos = S.batch_repositories(df)
    assert repos.where("quality.scores['tests_ci_release'] = 15 AND hard_filter['readme_clear']").count() == 2


def test_conformance(spark):
    assert conformance(spark, batch()) == set()
    assert ("batch", "not_json") in conformance(spark, "{nope")
    b = batch()
    b["extra"], b["schema_version"] = 1, True
    b["pages"].pop()
    b["pages"][0]["entries"][0].update(rank=True, full_name="a b/c", total_stars=-1, built_by="x")
    b["pages"][1]["scope"] = "cobol"
    del b["pages"][2]["status"]
    b["repositories"][0].update(is_fork="no", more=1)
    b["repositories"][1]["card"] = {**b["repositories"][1]["card"], "features": ["one"], "ai": "x"}
    assert conformance(spark, b) == {
        ("batch", "extra_field"), ("batch", "schema_version_type"), ("batch", "schema_version"), ("batch", "page_count"),
        ("entry", "rank"), ("entry", "full_name"), ("entry", "total_stars"), ("entry", "built_by_type"), ("page", "scope"),
        ("page", "missing_field"), ("repository", "is_fork_type"), ("repository", "extra_field"),
        ("repository", "card_features_items"), ("repository", "card_extra_field"),
    }
    null = batch()
    null["pages"][0]["entries"][0]["period_stars"] = None
    assert conformance(spark, null) == set()


def test_only_written_dates_are_replaced(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "capture_date DATE, v INT")
    path = str(tmp_path / "t")
    S.write_dated(rows((DAY, 1), (date(2026, 1, 1), 2)), path)
    S.write_dated(rows((DAY, 3)), path)
    got = {(r.capture_date, r.v) for r in spark.read.parquet(path).collect()}
    assert got == {(DAY, 3), (date(2026, 1, 1), 2)}


def test_files_are_hashed_and_bound(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.md").write_bytes("é".encode())
    (tmp_path / "y.md").write_bytes(b"y")
    files = read_files(spark, str(tmp_path), "*.md")
    got = {r.path: r.bytes for r in M.content_hashes(files).collect()}
    assert got == {"a/x.md": 2, "y.md": 1}
    assert P.BATCH_VERSION == 4
