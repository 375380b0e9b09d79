"""Percentiles, momentum, trend scores, gates and the evaluation waterfall."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions.rows import join_null_safe
from rankloom.functions.scalars import (
    age_days,
    distinct_sorted,
    grade,
    hot_type,
    momentum,
    round2,
    weighted,
)
from rankloom.operators.boards import periods_present, success_pages_only


def value_bucket(value: Column, per_octave: int = 1024) -> Column:
    """A non-decreasing bucket number with relative width 1/per_octave, for values of any size.

    The number of buckets follows from the type (the octaves of a double, each side), not from
    the data, while fractions and large ranges alike spread over many buckets. Zero has its own.
    """
    number = value.cast("double")
    magnitude = F.floor((F.log2(F.abs(number)) + 1075) * per_octave) + 1
    return F.when(number == 0, F.lit(0)).otherwise(F.signum(number) * magnitude).cast("bigint")


def value_histogram(values: DataFrame, by: tuple[str, ...], value: str) -> DataFrame:
    """Per population: each distinct value with its count, the number of smaller values and
    the population size.

    Rows are combined to (value, count) before the shuffle, so a value shared by a third of
    the rows costs one row per task. The running count is taken inside value buckets and the
    buckets' offsets are added, so no task sees a whole population.
    """
    counts = (
        values.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count("*").alias("equal"))
        .withColumn("bucket", value_bucket(F.col(value)))
    )
    running = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.groupBy(*by, "bucket")
        .agg(F.sum("equal").alias("in_bucket"))
        .withColumn("before", F.coalesce(F.sum("in_bucket").over(running), F.lit(0)))
        .withColumn("known", F.sum("in_bucket").over(Window.partitionBy(*by)))
        .drop("in_bucket")
    )
    inside = Window.partitionBy(*by, "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        # a left join leaves the counts as they are, so both uses share one shuffle
        join_null_safe(counts, offsets, (*by, "bucket"))
        .withColumn("less", F.col("before") + F.coalesce(F.sum("equal").over(inside), F.lit(0)))
        .select(*by, value, "equal", "less", "known")
    )


def midrank(less: Column, equal: Column, known: Column) -> Column:
    ranked = F.lit(100.0) * (less + (equal - 1) / 2) / (known - 1)
    return F.when(known >= 2, ranked)


def midrank_percentile(
    values: DataFrame, by: tuple[str, ...], value: str, name: str = "percentile", neutral: float = P.NEUTRAL
) -> DataFrame:
    """Tie-aware percentile of each value in its population; missing or single values are neutral."""
    ranks = value_histogram(values, by, value).select(
        *by, value, midrank(F.col("less"), F.col("equal"), F.col("known")).alias(name)
    )
    return join_null_safe(values, ranks, (*by, value)).withColumn(name, F.coalesce(name, F.lit(neutral)))


def previous_snapshot_date(snapshots: DataFrame, capture: date) -> DataFrame:
    """One row: the newest snapshot date strictly before ``capture`` (null when there is none).

    It is the date of any page, failed ones too, for all uses; of a table partitioned by date no
    column is read for it."""
    return snapshots.where(F.col("capture_date") < F.lit(capture)).agg(F.max("capture_date").alias("previous_date"))


def previous_snapshot(snapshots: DataFrame, capture: date) -> DataFrame:
    """Rows of that snapshot. The date is a scalar subquery on the date column, so a table
    partitioned by it reads one partition."""
    return snapshots.where(F.col("capture_date") == previous_snapshot_date(snapshots, capture).scalar())


def momentum_join(snapshots: DataFrame, capture: date) -> DataFrame:
    """Current and previous average rank per current candidate, with the momentum score.

    Both snapshots are averaged in one aggregate keyed by name, in place of a join.
    """
    rows = success_pages_only(snapshots)
    prior = previous_snapshot_date(snapshots, capture).scalar()
    is_now = F.col("capture_date") == F.lit(capture)
    means = (
        rows.where(is_now | (F.col("capture_date") == prior))
        .groupBy("full_name")
        .agg(
            F.avg(F.when(is_now, F.col("rank"))).alias("current_rank"),
            F.avg(F.when(~is_now, F.col("rank"))).alias("previous_rank"),
        )
        .where(F.col("current_rank").isNotNull())
    )
    return means.withColumn("rank_momentum", momentum(F.col("previous_rank"), F.col("current_rank")))


def trend_boards(snapshots: DataFrame, captures: list[date]) -> DataFrame:
    """Trend components and score of every candidate of the given captures, in one pass.

    A snapshot row counts for its own capture, and as the previous rank for the capture that
    follows it. One aggregate by (capture, name) gives all measures; the percentiles of all
    captures and periods come from one value histogram.
    """
    # the explicit null check keeps all uses of the measures alike, so they share one shuffle
    rows = success_pages_only(snapshots).where(F.col("full_name").isNotNull())
    uses, needed = [], F.lit(False)
    for capture in captures:
        prior = previous_snapshot_date(snapshots, capture).scalar()
        own, before = F.col("capture_date") == F.lit(capture), F.col("capture_date") == prior
        needed = needed | own | before
        for condition, now in ((own, True), (before, False)):
            uses.append(F.when(condition, F.struct(F.lit(capture).alias("capture_date"), F.lit(now).alias("now"))))
    used = rows.where(needed).withColumn("use", F.array_compact(F.array(*uses)))
    used = used.select(F.explode("use").alias("use"), "full_name", "rank", "period", "period_stars")
    now = lambda column: F.when(F.col("use.now"), column)
    measures = (
        used.groupBy("use.capture_date", "full_name")
        .agg(
            F.avg(now(F.col("rank"))).alias("current_rank"),
            F.avg(F.when(~F.col("use.now"), F.col("rank"))).alias("previous_rank"),
            F.count(now(F.col("rank"))).alias("appearance_count"),
            *[F.max(now(F.when(F.col("period") == p, F.col("period_stars")))).alias(f"{p}_stars") for p in P.PERIODS],
            *[F.max(now((F.col("period") == p).cast("int"))).alias(f"in_{p}") for p in P.PERIODS],
        )
        .where(F.col("current_rank").isNotNull())
    )
    return score_trend(measures)


def trend_board(snapshots: DataFrame, capture: date) -> DataFrame:
    """The trend of one capture."""
    return trend_boards(snapshots, [capture]).drop("capture_date")


CANDIDATE = ("capture_date", "full_name")


def with_period_percentiles(measures: DataFrame) -> DataFrame:
    """Add ``<period>_percentile`` from ``<period>_stars``: one histogram for all captures and
    periods, one lookup per candidate and period, gathered back by candidate."""
    long = measures.select(
        *CANDIDATE,
        F.explode(
            F.array(*[F.struct(F.lit(p).alias("period"), F.col(f"{p}_stars").alias("stars")) for p in P.PERIODS])
        ).alias("m"),
    ).select(*CANDIDATE, "m.period", "m.stars")
    ranked = midrank_percentile(long, ("capture_date", "period"), "stars")
    wide = ranked.groupBy(*CANDIDATE).agg(
        *[F.max(F.when(F.col("period") == p, F.col("percentile"))).alias(f"{p}_percentile") for p in P.PERIODS]
    )
    return measures.join(wide, list(CANDIDATE))


def score_trend(measures: DataFrame) -> DataFrame:
    scored = (
        with_period_percentiles(measures)
        .withColumn("periods_present", periods_present())
        .withColumn("rank_momentum", momentum(F.col("previous_rank"), F.col("current_rank")))
        .withColumn("cross_period", F.size("periods_present") * 100.0 / len(P.PERIODS))
    )
    parts = {name: round2(F.col(name)) for name in P.TREND_WEIGHTS}
    exact = weighted(parts, P.TREND_WEIGHTS)
    return scored.select(
        *CANDIDATE,
        *[parts[name].alias(name) for name in P.TREND_WEIGHTS],
        F.round(exact, 2).cast("double").alias("trend_score"),
        (exact >= P.TREND_PASS).alias("trend_pass"),
        *[f"{p}_stars" for p in P.PERIODS],
        "appearance_count",
        "periods_present",
        round2(F.col("current_rank")).alias("average_rank"),
        round2(F.col("previous_rank")).alias("previous_average_rank"),
    )


# --- evaluation ------------------------------------------------------------------------


def gate_failures() -> Column:
    """Failing state flags, then failing gates, in their fixed order. A gate that is missing fails."""
    checks = [F.when(F.col(flag), F.lit(flag)) for flag in P.STATE_FLAGS]
    checks += [
        F.when(~F.coalesce(F.try_element_at("hard_filter", F.lit(gate)), F.lit(False)), F.lit(gate)) for gate in P.GATES
    ]
    return F.array_compact(F.array(*checks))


def hard_filter(enrichment: DataFrame) -> DataFrame:
    return enrichment.withColumn("gate_failures", gate_failures()).withColumn(
        "gate_pass", F.size("gate_failures") == 0
    )


def primary_period_of(percentiles: dict[str, Column], present: Column) -> Column:
    """Period with the highest percentile among those present; earlier periods win ties."""
    anywhere = F.coalesce(F.size(present), F.lit(0)) <= 0
    ranked = F.array_compact(
        F.array(
            *[
                F.when(
                    anywhere | F.array_contains(present, p),
                    F.struct(
                        F.coalesce(percentiles[p], F.lit(P.NEUTRAL)).alias("percentile"),
                        F.lit(-i).alias("order"),
                        F.lit(p).alias("period"),
                    ),
                )
                for i, p in enumerate(P.PERIODS)
            ]
        )
    )
    return F.array_max(ranked)["period"]


def primary_period(trend: DataFrame) -> DataFrame:
    percentiles = {p: F.col(f"{p}_percentile") for p in P.PERIODS}
    return trend.withColumn("primary_period", primary_period_of(percentiles, F.col("periods_present")))


def final_score(trend: Column, quality: Column, value: Column) -> Column:
    """Weighted final score on the rounded trend score, two decimals."""
    parts = {"trend": trend, "quality": quality, "value": value}
    return F.round(weighted(parts, P.FINAL_WEIGHTS), 2).cast("double")


def candidate_enrichment(trend: DataFrame, enrichment: DataFrame, keys: tuple[str, ...] = ("full_name",)) -> DataFrame:
    """Attach trend to enrichment by key. Both sides are unique by key, so no key is hot."""
    return enrichment.join(trend, list(keys))


def waterfall(df: DataFrame) -> DataFrame:
    """First failing stage, its reasons, status and grade; the score exists for all rows."""
    scored = df.withColumn("final_score", final_score(F.col("trend_score"), F.col("quality.total"), F.col("value.total")))
    scored = scored.withColumn("grade", grade(F.col("final_score")))
    stage = (
        F.when(~F.col("gate_pass"), "hard_filter")
        .when(~F.col("trend_pass"), "trend")
        .when(F.col("quality.total") < P.QUALITY_PASS, "quality")
        .when(F.col("value.total") < P.VALUE_PASS, "value")
        .when(F.col("grade").isNull(), "final")
    )
    scored = scored.withColumn("rejection_stage", stage)
    reason = {
        "trend": f"trend_score_below_{P.TREND_PASS:g}",
        "quality": f"quality_score_below_{P.QUALITY_PASS}",
        "value": f"value_score_below_{P.VALUE_PASS}",
        "final": f"final_score_below_{P.FINAL_PASS:g}",
    }
    reasons = F.when(F.col("rejection_stage") == "hard_filter", F.col("gate_failures"))
    for name, text in reason.items():
        reasons = reasons.when(F.col("rejection_stage") == name, F.array(F.lit(text)))
    return scored.withColumn("rejection_reasons", reasons.otherwise(F.array().cast("array<string>"))).withColumn(
        "status", F.when(F.col("rejection_stage").isNull(), "accepted").otherwise("rejected")
    )


def evidence_union() -> Column:
    return distinct_sorted(
        F.col("evidence_urls"),
        F.col("license.evidence_urls"),
        F.col("quality.evidence_urls"),
        F.col("value.evidence_urls"),
    )


def evaluate(enrichment: DataFrame, trend: DataFrame, capture: date | None = None) -> DataFrame:
    """Evaluation record of every enriched candidate.

    With ``capture`` both inputs belong to that capture; without it both have a
    ``capture_date`` and are matched on it, too.
    """
    if capture is not None:
        enrichment = enrichment.withColumn("capture_date", F.lit(capture))
        trend = trend.withColumn("capture_date", F.lit(capture))
    joined = candidate_enrichment(trend, hard_filter(enrichment), CANDIDATE)
    age = age_days(F.col("capture_date"), F.col("created_at"))
    return (
        primary_period(waterfall(joined))
        .withColumn("repository_age_days", age)
        .withColumn("hot_type", hot_type(age))
        .withColumn("all_evidence_urls", evidence_union())
    )
