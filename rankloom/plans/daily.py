"""One day's batch from document to published tables, and the audit of what is published.

Tables below a folder: ``pages``, ``snapshots``, ``evaluations``, ``rejections``, ``editions``,
``features``, ``reports``, ``commits/files`` (all by ``capture_date``) and ``catalog``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions.rows import unnest
from rankloom.operators import boards as B
from rankloom.operators import edition as E
from rankloom.operators import ranking as R
from rankloom.operators import rules as U
from rankloom.operators.manifests import content_hashes
from rankloom.session import stored
from rankloom.sources.batches import batch_entries, batch_repositories, read_batch, schema_conformance, write_snapshots
from rankloom.sources.tables import read_files
from rankloom.streaming.catalog import catalog_version, upsert_into


COMMITS = "commits"


def expected_pages(spark: SparkSession) -> DataFrame:
    pairs = [(scope, period) for period in P.PERIODS for scope in P.SCOPES]
    return spark.createDataFrame(pairs, "scope STRING, period STRING")


def _issues(df: DataFrame, check: str, item: Column, rules: Column) -> DataFrame:
    return unnest(df, rules, "rule", F.lit(check).alias("check"), item.cast("string").alias("item"))


def batch_issues(raw: DataFrame, batch: DataFrame, entries: DataFrame, repositories: DataFrame) -> DataFrame:
    """Everything that keeps a batch from being published: (check, item, rule)."""
    spark = batch.sparkSession
    candidates = B.distinct_candidates(entries)
    pages = entries.select("page_no", "scope", "period").distinct()
    one = lambda rule: F.array(rule if isinstance(rule, Column) else F.lit(rule))
    name = F.col("full_name")
    cards = U.text_lint_rules(repositories, U.card_fields())
    repeated = [
        _issues(U.duplicate_fingerprints(repositories, "full_name", F.col(f"card.{f}")), "card", F.col("member"), one(f"{f}_repeated"))
        for f in ("features", "strengths")
    ]
    pool = batch.select("candidate_pool.*")
    declared = pool.select(F.max("raw_candidate_count")).scalar(), pool.select(F.max("evaluated_candidate_count")).scalar()
    counts = U.pool_counts(candidates, repositories, *declared)
    parts = [
        _issues(
            schema_conformance(raw), "schema", F.concat_ws(" ", "object", F.col("position").cast("string")), F.col("violations")
        ),
        _issues(U.page_rules(entries), "page", F.concat_ws(" ", "scope", "period", "full_name"), F.col("violations")),
        _issues(U.duplicate_ranks(entries), "page", F.concat_ws(" ", "scope", "period"), one("repeated_rank")),
        _issues(U.matrix_coverage(pages, expected_pages(spark)), "matrix", F.concat_ws(" ", "scope", "period"), one(F.col("outcome"))),
        _issues(U.duplicate_keys(repositories), "repository", name, one("repeated_key")),
        _issues(U.enrichment_rules(repositories), "repository", name, F.col("violations")),
        _issues(cards, "card", name, F.col("violations")),
        *repeated,
        _issues(U.pool_reconcile(candidates, repositories), "pool", name, one(F.col("side"))),
        _issues(counts.where(~F.coalesce(F.col("raw_match") & F.col("evaluated_match"), F.lit(False))), "pool", F.lit("counts"), one("mismatch")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def ingest(spark: SparkSession, batch_path: str, folder: str) -> DataFrame:
    """Validate a batch, score it, and publish it below ``folder``; gives the edition's counts.

    A batch with issues raises and publishes nothing. The same batch may be published again:
    its dates are replaced and the catalog stays as it is.
    """
    raw = spark.read.text(batch_path, wholetext=True).select(F.input_file_name().alias("doc"), F.col("value").alias("text"))
    batch = read_batch(spark, batch_path)
    entries = stored(batch_entries(batch), "entries")
    repositories = stored(batch_repositories(batch), "repositories")
    first = U.issue_sample(stored(batch_issues(raw, batch, entries, repositories), "issues"), ["check", "item", "rule"]).collect()
    if first:
        listed = "; ".join(f"{r.check} {r.item}: {r.rule}" for r in first)
        raise ValueError(f"batch has {first[0].total} issues: {listed}")
    captures = [r[0] for r in batch.select(F.to_date("capture_date")).distinct().limit(2).collect()]
    if len(captures) != 1:
        raise ValueError("a batch has one capture date; publish each date's documents by themselves")
    capture: date = captures[0]

    paths = write_snapshots(folder, snapshots=B.success_pages_only(entries), pages=page_headers(entries))
    trend = R.trend_board(spark.read.parquet(paths["snapshots"]), capture)
    scored = R.evaluate(repositories.drop("capture_date"), trend, capture)
    path = write_snapshots(folder, evaluations=scored)["evaluations"]
    evaluations = spark.read.schema(scored.schema).parquet(path).where(F.col("capture_date") == F.lit(capture))

    root = f"{folder}/catalog"
    upsert_into(spark, root, evaluations)
    held = catalog_version(spark, root)

    features = stored(E.period_features(evaluations, held, capture), "features")
    record = E.edition_record(features, capture).withColumn("capture_date", F.col("date"))
    broken = E.edition_rules(record).where(F.size("violations") > 0)
    if not broken.isEmpty():
        raise ValueError("the edition breaks its rules")
    stats = E.edition_stats(page_headers(entries), trend, evaluations, held, capture)
    write_snapshots(
        folder,
        features=features,
        editions=record,
        reports=E.daily_report(features, evaluations),
        rejections=E.rejections(evaluations),
        stats=stats,
    )
    commit_files(spark, folder, capture)
    return spark.read.schema(stats.schema).parquet(f"{folder}/stats").where(F.col("capture_date") == F.lit(capture))


def published_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path below ``folder``, sha256) of all files of the published tables; contents stay in the scan."""
    files = read_files(spark, folder, "*.parquet")
    return content_hashes(files.where(~F.startswith("path", F.lit(COMMITS)))).select("path", "sha256")


def commit_files(spark: SparkSession, folder: str, capture: date) -> None:
    """Note what is published as of a capture, one row per file."""
    rows = published_files(spark, folder).withColumn("capture_date", F.lit(capture))
    write_snapshots(f"{folder}/{COMMITS}", **{"files": rows})


def committed_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Files of the newest commit that are missing or have other bytes: (path, outcome)."""
    commits = spark.read.parquet(f"{folder}/{COMMITS}/files")
    newest = commits.agg(F.max("capture_date")).scalar()
    manifest = commits.where(F.col("capture_date") == newest).select("path", "sha256")
    actual = published_files(spark, folder).withColumnRenamed("sha256", "actual_sha256")
    outcome = F.when(F.col("actual_sha256").isNull(), "missing").when(F.col("actual_sha256") != F.col("sha256"), "changed")
    return manifest.join(actual, "path", "left").select("path", outcome.alias("outcome")).where("outcome IS NOT NULL")


def page_headers(entries: DataFrame) -> DataFrame:
    header = ("capture_date", "page_no", "scope", "period", "source_url", "captured_at", "raw_sha256", "status")
    return entries.select(*header).distinct()


def snapshot_issues(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Pages of a capture without a snapshot row or the other way round, and statistics that say another number of pages."""
    key = ["capture_date", "page_no"]
    pages = spark.read.parquet(f"{folder}/pages")
    told = spark.read.parquet(f"{folder}/stats").select("capture_date", "pages")
    counted = pages.select(*key).distinct().groupBy("capture_date").agg(F.count("*").alias("actual"))
    unknown = spark.read.parquet(f"{folder}/snapshots").select(*key).distinct().join(pages.select(*key), key, "left_anti")
    wrong = told.join(counted, "capture_date", "full").where(~F.col("pages").eqNullSafe(F.col("actual")))
    item = F.col("capture_date").cast("string").alias("item")
    return [
        unknown.select(F.lit("snapshot of an unknown page").alias("check"), F.concat_ws(" ", "capture_date", "page_no").alias("item")),
        wrong.select(F.lit("page count").alias("check"), item),
    ]


def audit(spark: SparkSession, folder: str) -> DataFrame:
    """Issues of the published tables: (check, item). An empty result is a pass."""
    held = catalog_version(spark, f"{folder}/catalog")
    editions = spark.read.parquet(f"{folder}/editions")
    evaluations = spark.read.parquet(f"{folder}/evaluations")
    shown = E.displayed_union(editions)
    missing = shown.join(held.select("full_name"), "full_name", "left_anti")
    unknown = E.feature_lookup(spark.read.parquet(f"{folder}/features"), evaluations).where("missing")
    parts = [
        U.duplicate_keys(held).select(F.lit("repeated catalog key").alias("check"), F.col("full_name").alias("item")),
        missing.select(F.lit("displayed but not in catalog").alias("check"), F.col("full_name").alias("item")),
        unknown.select(F.lit("featured without evaluation").alias("check"), F.col("full_name").alias("item")),
        E.edition_rules(editions)
        .where(F.size("violations") > 0)
        .select(F.lit("edition rules").alias("check"), F.col("date").cast("string").alias("item")),
        *snapshot_issues(spark, folder),
        committed_changes(spark, folder).select(F.concat(F.lit("committed file "), "outcome").alias("check"), F.col("path").alias("item")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
