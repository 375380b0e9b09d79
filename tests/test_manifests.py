import hashlib
import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.operators import evidence as V
from rankloom.operators import manifests as M
from rankloom.operators import references as A


def digest(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_latest_manifest_is_verified(spark):
    commits = spark.createDataFrame(
        [("2026-01-01", {"old": "x"}), ("2026-01-02", {"a": digest("1"), "b": digest("2"), "c": "x"})], "run_id STRING, files MAP<STRING, STRING>"
    )
    files = spark.createDataFrame([("a", b"1"), ("b", b"changed"), ("z", b"")], "path STRING, content BINARY")
    got = {r.path: r.outcome for r in M.manifest_hash_verify(M.latest_manifest(commits), files).collect()}
    assert got == {"a": "ok", "b": "changed", "c": "missing"}


def test_bind_sources_with_a_hot_hash(spark):
    manifest = [(f"n{i}", digest("same").upper(), 4) for i in range(40)] + [("x", digest("other"), 1), ("y", "0" * 64, 1)]
    m = spark.createDataFrame(manifest, "full_name STRING, source_sha256 STRING, source_bytes INT")
    s = spark.createDataFrame([("p1", b"same"), ("p2", b"same"), ("p3", b"other")], "path STRING, content BINARY")
    rows = {r.full_name: r for r in M.bind_sources(m, s).collect()}
    assert len(rows) == 42
    assert (rows["n0"].outcome, rows["n0"].source_path, rows["n0"].source_artifact) == ("bound", "p2", f"readmes/sources/{digest('same')}.md")
    assert (rows["x"].outcome, rows["y"].outcome) == ("size_mismatch", "missing")


def test_incremental_equals_full(spark):
    render = lambda t: F.upper(t)
    inputs = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("c",)], "text STRING")
    none = spark.createDataFrame([], "content_key STRING, output STRING, output_sha256 STRING")
    full = M.incremental_by_hash(inputs, none, render, "v1")
    assert tuple(M.incremental_summary(full).select("rows", "misses", "hits").first()) == (5, 3, 2)
    store = full.select("content_key", "output", F.sha2("output", 256).alias("output_sha256")).distinct()
    damaged = store.withColumn("output", F.when(F.col("output") == "C", "damaged").otherwise(F.col("output")))
    for limit in (M.BROADCAST_LIMIT, 0):
        again = M.incremental_by_hash(inputs, damaged, render, "v1", broadcast_limit=limit).collect()
        assert sorted(r.output for r in again) == ["A", "B", "B", "C", "C"]
        assert {r.output: r.hit for r in again} == {"A": True, "B": True, "C": False}
    assert not any(r.hit for r in M.incremental_by_hash(inputs, store, render, "v2").collect())


def test_group_sizes(spark):
    files = spark.createDataFrame(
        [("run-2026-01-01", 10, 4), ("run-2026-01-01", 5, 1), ("run-2026-01-09", 1, 1), ("run-2026-13-01", 1, 1), ("xrun-2026-01-01", 1, 1)],
        "group STRING, bytes BIGINT, packed_bytes BIGINT",
    )
    (row,) = M.group_sizes(files, date(2026, 1, 9)).collect()
    assert (row.group, row.files, row.bytes, row.saved_bytes) == ("run-2026-01-01", 2, 15, 10)


# --- evidence -------------------------------------------------------------------------------

DAY = date(2026, 9, 5)


def record(kind, day, name="a/b", manifest=None, status="success", fetched=None, content="{}", sha=None, url=None):
    return (
        name, manifest or name, day, kind, url or f"{P.API_SITE}/{name}{P.EVIDENCE_ENDPOINTS[kind]}", status,
        sha or digest(content), fetched, bytearray(content.encode()),
    )


def reused(spark, *records, **options):
    schema = "full_name STRING, manifest_name STRING, cached_day DATE, kind STRING, url STRING, status STRING, sha256 STRING, fetched_on DATE, content BINARY"
    candidates = spark.createDataFrame([("a/b",)], "full_name STRING")
    rows = V.evidence_asof_reuse(V.evidence_requests(candidates), spark.createDataFrame(list(records), schema), DAY, **options).collect()
    assert len(rows) == 4
    return {r.kind: r.fetched_on for r in rows if r.reused}


def test_refresh_uses_no_record(spark):
    held = [record("readme", DAY), record("license", DAY)]
    assert reused(spark, *held, refresh=F.lit(True)) == {}
    assert reused(spark, *held, refresh=F.col("kind") == "readme").keys() == {"license"}
    assert reused(spark, *held, refresh=F.lit(None).cast("boolean")).keys() == {"readme", "license"}


def test_reuse(spark):
    before = DAY - timedelta(days=1)
    assert reused(spark, record("readme", before), record("license", DAY, fetched=before)) == {"readme": before, "license": before}
    # an original fetch that is too old is not made younger by a copy
    assert reused(spark, record("readme", DAY, fetched=DAY - timedelta(days=2))) == {}
    assert reused(spark, record("readme", DAY - timedelta(days=2)), record("license", DAY + timedelta(days=1))) == {}
    # corrupt, unparsable, failed, other url
    assert reused(spark, record("readme", DAY, sha="0"), record("license", DAY, content="{x"), record("repository", DAY, status="failed"), record("root_contents", DAY, url="x")) == {}
    # an older sound record is used when the newer one is corrupt
    assert reused(spark, record("readme", DAY, sha="0"), record("readme", before)) == {"readme": before}
    # repeated kinds or another key spoil the whole manifest
    assert reused(spark, record("readme", DAY), record("readme", DAY), record("license", DAY)) == {}
    assert reused(spark, record("readme", DAY, manifest="c/d"), record("license", DAY)) == {}


# --- references -----------------------------------------------------------------------------


def test_references_against_all_pairs(spark):
    rnd = random.Random(3)
    words = ["run", "2026", "proof", "Test", "a", "rollback", "x-1", "é", "…", "-", "\\", "/"]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice(["", " ", "/", "-"]) for _ in range(n))
    texts = [(i, text(rnd.randint(0, 25))) for i in range(80)]
    # a third of the texts holds the same passage
    texts += [(100 + i, "see proof/run-2026/rollback-test now") for i in range(40)]
    targets = [(i, text(rnd.randint(1, 4))) for i in range(60)] + [(90, "PROOF\\run-2026/rollback-test"), (91, "un"), (92, "-"), (93, "t n"), (94, " "), (95, "//")]
    norm = lambda s: s.replace("\\", "/").lower()
    want = {(i, j) for i, t in texts for j, p in targets if p.strip() and norm(p) in norm(t)}
    frames = spark.createDataFrame(texts, "text_id INT, text STRING"), spark.createDataFrame(targets, "target_id INT, target STRING")
    for limit in (A.BROADCAST_LIMIT, 0):
        got = A.active_references(*frames, broadcast_limit=limit).collect()
        assert len(got) == len(set(map(tuple, got)))
        assert set(map(tuple, got)) == want
