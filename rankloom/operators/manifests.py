"""Manifests, hashes and sets of artifacts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.operators.rules import symmetric_difference
from rankloom.session import stored

BROADCAST_LIMIT = 64 * 1024 * 1024
KEY_BYTES = 128


def latest_manifest(commits: DataFrame) -> DataFrame:
    """(path, sha256) of the newest commit; ``commits`` has (run_id, files MAP)."""
    newest = commits.agg(F.max("run_id")).scalar()
    return commits.where(F.col("run_id") == newest).select(F.explode("files").alias("path", "sha256"))


def content_hashes(files: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """(key, sha256, bytes); the content stays in the scan stage."""
    body = F.col(content).cast("binary")
    return files.select(key, F.sha2(body, 256).alias("sha256"), F.octet_length(body).cast("bigint").alias("bytes"))


def manifest_hash_verify(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Every manifest row with its outcome: ok, changed or missing."""
    actual = content_hashes(files).select("path", F.col("sha256").alias("actual_sha256"))
    outcome = (
        F.when(F.col("actual_sha256").isNull(), "missing")
        .when(F.lower("sha256") != F.col("actual_sha256"), "changed")
        .otherwise("ok")
    )
    return manifest.join(actual, "path", "left").withColumn("outcome", outcome)


def sources_by_hash(sources: DataFrame) -> DataFrame:
    """One source per content hash (the last path of equal ones), so lookups are unique."""
    hashed = content_hashes(sources)
    return hashed.groupBy("sha256").agg(F.max("path").alias("source_path"), F.max("bytes").alias("actual_bytes"))


def bind_sources(manifest: DataFrame, sources: DataFrame, folder: str = "readmes/sources") -> DataFrame:
    """Match each manifest row to a source by hash and verify its size."""
    digest = F.lower("source_sha256")
    bound = manifest.withColumn("sha256", digest).join(sources_by_hash(sources), "sha256", "left")
    outcome = (
        F.when(F.col("source_path").isNull(), "missing")
        .when(F.col("actual_bytes") != F.col("source_bytes"), "size_mismatch")
        .otherwise("bound")
    )
    return bound.withColumn("outcome", outcome).withColumn(
        "source_artifact", F.when(F.col("outcome") == "bound", F.concat(F.lit(folder + "/"), "sha256", F.lit(".md")))
    )


def manifest_source_join(manifest: DataFrame, sources: DataFrame) -> DataFrame:
    """Inner form of the match by hash."""
    return manifest.withColumn("sha256", F.lower("source_sha256")).join(sources_by_hash(sources), "sha256")


def incremental_by_hash(
    inputs: DataFrame,
    store: DataFrame,
    render: Callable[[Column], Column],
    version: str,
    text: str = "text",
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Stored results where the content hash is known, computed ones elsewhere.

    ``store`` is (content_key, output, output_sha256). A stored row whose own hash is wrong
    is a miss. The result has the input columns but the text, and content_key, hit, output.

    The texts are hashed to a narrow table first; known keys take their output from the store
    without the text. Missing keys are measured: a short list is broadcast to the texts, a
    long one is matched by shuffle.
    """
    key = F.sha2(F.concat(F.lit(version + "\n"), F.col(text)), 256)
    others = [c for c in inputs.columns if c != text]
    keyed = stored(inputs.select(*others, key.alias("content_key")), "content_keys")
    sound = (
        store.where(F.sha2("output", 256) == F.col("output_sha256"))
        .groupBy("content_key")
        .agg(F.max("output").alias("output"))
    )
    missing = stored(
        keyed.select("content_key").distinct().join(sound.select("content_key"), "content_key", "left_anti"), "missing_keys"
    )
    short = missing.count() * KEY_BYTES <= broadcast_limit
    computed = (
        inputs.withColumn("content_key", key)
        .join(F.broadcast(missing) if short else missing, "content_key", "left_semi")
        .select(*others, "content_key", F.lit(False).alias("hit"), render(F.col(text)).alias("output"))
    )
    known = keyed.join(sound, "content_key").select(*others, "content_key", F.lit(True).alias("hit"), "output")
    return known.unionByName(computed)


def incremental_summary(results: DataFrame) -> DataFrame:
    """Hits and misses; of equal new texts only the first is a miss."""
    per_key = results.groupBy("content_key").agg(F.count("*").alias("n"), F.max("hit").alias("hit"))
    misses = F.count_if(~F.col("hit"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(total.alias("rows"), misses.alias("misses")).withColumn("hits", F.col("rows") - F.col("misses"))


def coverage_subset(displayed: DataFrame, catalog: DataFrame, key: str = "full_name") -> DataFrame:
    """Displayed keys that the catalog lacks."""
    return displayed.select(key).distinct().join(catalog.select(key), key, "left_anti")


def set_equality_audit(audits: dict[str, tuple[DataFrame, DataFrame]], key: str = "item") -> DataFrame:
    """Named (actual, expected) pairs compared as sets; one row per missing or extra item."""
    out = None
    for name, (actual, expected) in audits.items():
        diff = symmetric_difference(actual.select(key), expected.select(key)).select(
            F.lit(name).alias("audit"), key, "side"
        )
        out = diff if out is None else out.unionByName(diff)
    return out


def duplicate_bodies(documents: DataFrame, body: str) -> DataFrame:
    """One row: documents, distinct bodies, documents that share a body, and the verdict."""
    per_hash = documents.groupBy(F.sha2(body, 256).alias("sha256")).agg(F.count("*").alias("n"))
    return per_hash.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("documents"),
        F.count("*").alias("distinct_bodies"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("in_repeated_groups"),
    ).withColumn("unique", F.col("documents") == F.col("distinct_bodies"))


def stale_artifacts(source: DataFrame, target: DataFrame, key: str = "path") -> DataFrame:
    """Present in the target, absent in the source."""
    return target.select(key).distinct().join(source.select(key), key, "left_anti")


def group_sizes(
    files: DataFrame, before: date, pattern: str = r"^run-(\d{4}-\d{2}-\d{2})$", group: str = "group"
) -> DataFrame:
    """Files, bytes and saved bytes per dated group strictly before a date.

    ``files`` has (group, bytes, packed_bytes); groups whose name is not a date do not count.
    """
    day = F.try_to_date(F.nullif(F.regexp_extract(group, pattern, 1), F.lit("")), "yyyy-MM-dd")
    dated = files.withColumn("day", day).where(F.col("day") < F.lit(before))
    return dated.groupBy(group, "day").agg(
        F.count("*").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sum(F.col("bytes") - F.col("packed_bytes")).alias("saved_bytes"),
    )
