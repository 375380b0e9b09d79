"""Daily editions: capped selection per period, statistics, rules and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions.scalars import violations
from rankloom.operators.catalog import newly_accepted


def period_features(
    evaluations: DataFrame, catalog: DataFrame, capture: date, limit: int = P.FEATURES_PER_PERIOD
) -> DataFrame:
    """New accepted candidates by score, each in its one primary period, at most ``limit`` a
    period; what does not fit is dropped, not moved. The cut happens per task before the
    shuffle (window group limit)."""
    order = [F.desc("final_score"), F.lower("full_name"), F.col("full_name")]
    fresh = newly_accepted(evaluations, catalog, capture).dropDuplicates(["full_name"])
    place = F.row_number().over(Window.partitionBy("primary_period").orderBy(*order))
    return (
        fresh.withColumn("position", place)
        .where(F.col("position") <= limit)
        .select(
            F.lit(capture).alias("capture_date"),
            F.col("primary_period").alias("period"),
            "position",
            "full_name",
            "final_score",
        )
    )


def period_number(period: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, P.PERIODS)), period)


def edition_record(features: DataFrame, capture: date) -> DataFrame:
    """One row: features per period and the displayed list, in period order.

    The lists hold at most periods × limit names, so they are short whatever the input."""
    entry = F.struct(period_number(F.col("period")).alias("p"), "position", "period", "full_name")
    listed = features.agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    names = lambda rows: F.transform(rows, lambda r: r["full_name"])
    featured = F.map_from_arrays(
        F.array(*map(F.lit, P.PERIODS)),
        F.array(*[names(F.filter("rows", _in_period(p))) for p in P.PERIODS]),
    )
    return listed.select(
        F.lit(P.EDITION_VERSION).alias("schema_version"),
        F.lit(capture).alias("date"),
        featured.alias("featured"),
        names(F.col("rows")).alias("displayed"),
    )


def _in_period(period: str):
    return lambda row: row["period"] == period


def edition_stats(
    pages: DataFrame, candidates: DataFrame, evaluations: DataFrame, catalog: DataFrame, capture: date
) -> DataFrame:
    """The seven counts of an edition. Each input is reduced to one tagged row first."""
    names = ("pages", "raw_candidates", "evaluated", "accepted", "rejected", "newly_accepted", "catalog_entries")
    zero = F.lit(0).cast("bigint")

    def counts(df: DataFrame, **values: Column) -> DataFrame:
        return df.agg(*[values.get(n, zero).alias(n) for n in names])

    today = evaluations.where(F.col("capture_date") == F.lit(capture))
    parts = (
        counts(pages.where(F.col("capture_date") == F.lit(capture)), pages=F.count("*"))
        .unionByName(counts(candidates.select("full_name").distinct(), raw_candidates=F.count("*")))
        .unionByName(
            counts(
                today,
                evaluated=F.count("*"),
                accepted=F.count_if(F.col("status") == "accepted"),
                rejected=F.count_if(F.col("status") == "rejected"),
            )
        )
        .unionByName(counts(newly_accepted(evaluations, catalog, capture), newly_accepted=F.count("*")))
        .unionByName(counts(catalog, catalog_entries=F.count("*")))
    )
    total = parts.agg(*[F.sum(n).alias(n) for n in names])
    return total.select(F.lit(capture).alias("capture_date"), *names)


def edition_rules(editions: DataFrame) -> DataFrame:
    """Version, exact periods, no repeated feature, displayed list equals the lists in order."""
    listed = F.flatten(F.array(*[F.try_element_at("featured", F.lit(p)) for p in P.PERIODS]))
    rules = violations(
        (F.coalesce(F.col("schema_version") != P.EDITION_VERSION, F.lit(True)), "schema_version"),
        (
            F.coalesce(
                F.array_sort(F.map_keys("featured")) != F.array(*map(F.lit, sorted(P.PERIODS))), F.lit(True)
            ),
            "periods",
        ),
        (F.size(F.array_distinct(listed)) != F.size(listed), "duplicate_feature"),
        (F.coalesce(listed != F.col("displayed"), F.lit(True)), "displayed"),
    )
    return editions.withColumn("violations", rules)


def displayed_union(editions: DataFrame) -> DataFrame:
    """Distinct displayed names over all editions."""
    return editions.select(F.explode("displayed").alias("full_name")).distinct()


def feature_lookup(features: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Featured keys with their evaluation; ``missing`` where there is none."""
    known = evaluations.select("capture_date", "full_name", "status", F.col("final_score").alias("evaluated_score"))
    return features.join(known, ["capture_date", "full_name"], "left").withColumn("missing", F.col("status").isNull())


def daily_report(features: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Report lines: each feature with its scores and the metric of the period it is listed in."""
    metric = F.coalesce(*[F.when(F.col("f.period") == p, F.col(f"e.{p}_stars")) for p in P.PERIODS])
    joined = features.alias("f").join(
        evaluations.alias("e"),
        (F.col("f.capture_date") == F.col("e.capture_date")) & (F.col("f.full_name") == F.col("e.full_name")),
    )
    return joined.select(
        "f.capture_date",
        "f.period",
        "f.position",
        "f.full_name",
        F.col("e.grade").alias("grade"),
        F.col("e.trend_score").alias("trend_score"),
        F.col("e.quality.total").alias("quality_score"),
        F.col("e.value.total").alias("value_score"),
        F.col("e.final_score").alias("final_score"),
        F.coalesce(metric.cast("string"), F.lit(P.LABEL_NOT_SHOWN)).alias("period_stars"),
    )


def rejections(evaluations: DataFrame) -> DataFrame:
    return evaluations.where(F.col("status") == "rejected")
