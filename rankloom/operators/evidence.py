"""Evidence records: freshness-bounded reuse and newest record per kind."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom import params as P


def evidence_requests(candidates: DataFrame, endpoints: dict[str, str] = P.EVIDENCE_ENDPOINTS, site: str = P.API_SITE) -> DataFrame:
    """The records each candidate needs: one row per (key, kind) with its URL."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(tail).alias("tail")) for k, tail in endpoints.items()])
    rows = candidates.select("full_name").distinct().select("full_name", F.explode(kinds).alias("k"))
    return rows.select(
        "full_name", "k.kind", F.concat(F.lit(site + "/"), F.col("full_name"), F.col("k.tail")).alias("url")
    )


def _within(day: Column, capture: date, max_age: int) -> Column:
    return day.between(F.lit(capture - timedelta(days=max(0, max_age))), F.lit(capture))


def usable_records(records: DataFrame, capture: date, max_age: int = P.EVIDENCE_MAX_AGE_DAYS) -> DataFrame:
    """Cached records that may be reused at ``capture``.

    ``records`` is (full_name, manifest_name, cached_day, kind, url, status, sha256,
    fetched_on, content). The date filter reaches the scan. The content is reduced to one
    flag before any shuffle. A manifest is (full_name, cached_day): one that repeats a kind,
    or names another key, is ignored as a whole.
    """
    fetched = F.coalesce("fetched_on", "cached_day")
    intact = F.coalesce(
        (F.sha2("content", 256) == F.col("sha256")) & F.try_parse_json(F.col("content").cast("string")).isNotNull(),
        F.lit(False),
    )
    ok = (F.col("status") == "success") & _within(fetched, capture, max_age) & intact
    narrow = records.where(_within(F.col("cached_day"), capture, max_age)).select(
        "full_name",
        "cached_day",
        "kind",
        (F.col("manifest_name") != F.col("full_name")).alias("foreign"),
        F.struct(ok.alias("ok"), "url", "sha256", fetched.alias("fetched_on")).alias("record"),
    )
    # combine to one row per kind first, so a manifest of any size is small afterwards
    kinds = narrow.groupBy("full_name", "cached_day", "kind").agg(
        F.count("*").alias("copies"), F.max("foreign").alias("foreign"), F.max("record").alias("record")
    )
    manifest = Window.partitionBy("full_name", "cached_day")
    sound = (F.max("copies").over(manifest) == 1) & ~F.max("foreign").over(manifest)
    return (
        kinds.withColumn("sound", sound)
        .where(F.col("sound") & F.col("record.ok"))
        .select("full_name", "cached_day", "kind", "record.url", "record.sha256", "record.fetched_on")
    )


def evidence_asof_reuse(
    requests: DataFrame, records: DataFrame, capture: date, max_age: int = P.EVIDENCE_MAX_AGE_DAYS, refresh: Column | None = None
) -> DataFrame:
    """Each request with the newest usable record, or without one (a miss to be fetched).

    ``refresh`` is a condition on requests: those that it holds for are fetched anew, whatever there is.

    The as-of step is a ``max_by`` per (key, kind, url) before the join: no sort, no
    range join, and the lookup side is unique.
    """
    newest = (
        usable_records(records, capture, max_age)
        .groupBy("full_name", "kind", "url")
        .agg(F.max_by(F.struct("sha256", "fetched_on"), "cached_day").alias("hit"))
    )
    anew = F.lit(False) if refresh is None else F.coalesce(refresh, F.lit(False))
    joined = requests.join(newest, ["full_name", "kind", "url"], "left").withColumn("hit", F.when(~anew, F.col("hit")))
    return joined.select(
        "full_name",
        "kind",
        "url",
        F.col("hit").isNotNull().alias("reused"),
        F.col("hit.sha256").alias("sha256"),
        F.col("hit.fetched_on").alias("fetched_on"),
    )


def newest_per_kind(records: DataFrame, *columns: str, day: str = "fetched_on", tie: str = "sha256") -> DataFrame:
    """Newest successful record of each (key, kind); combined per task, without a sort."""
    best = F.max_by(F.struct(day, *columns), F.struct(day, tie)).alias("r")
    return records.where(F.col("status") == "success").groupBy("full_name", "kind").agg(best).select(
        "full_name", "kind", "r.*"
    )
