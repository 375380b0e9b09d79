import random
from bisect import bisect_left, bisect_right
from datetime import date

import pytest
from fixtures import FRESH, KNOWN, entries, entry, full_matrix, repositories, repository
from pyspark.sql import Row
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions import scalars as S
from rankloom.operators import ranking as R

DAY, BEFORE = date(2026, 8, 27), date(2026, 8, 20)


def plain_percentiles(values):
    """Mean place of a value in the sorted list, in percent of the last place; 50 where there is none."""
    ordered = sorted(v for v in values.values() if v is not None)
    if len(ordered) < 2:
        return dict.fromkeys(values, 50.0)
    place = {v: (bisect_left(ordered, v) + bisect_right(ordered, v) - 1) / 2 for v in set(ordered)}
    return {key: 50.0 if v is None else place[v] * 100 / (len(ordered) - 1) for key, v in values.items()}


@pytest.mark.parametrize("seed", range(4))
def test_midrank_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    groups = {}
    for g in ("a", "b", "c"):
        pool = [0, 1, 7, 7, 10**rnd.randint(1, 12), 500, -3]
        # one value holds about a third of the rows
        groups[g] = {i: rnd.choice([None, 7, 7, rnd.choice(pool), rnd.randint(0, 10**9)]) for i in range(120)}
    groups["single"] = {0: 5}
    groups["nothing"] = {0: None, 1: None}
    groups["equal"] = {i: 4 for i in range(5)}
    rows = [(g, i, v) for g, values in groups.items() for i, v in values.items()]
    df = spark.createDataFrame(rows, "g STRING, i INT, v BIGINT")
    got = {(r.g, r.i): r.percentile for r in R.midrank_percentile(df, ("g",), "v").collect()}
    want = {(g, i): p for g, values in groups.items() for i, p in plain_percentiles(values).items()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_value_buckets_never_decrease(spark):
    df = spark.range(-3000, 3000).select("id", R.value_bucket(F.col("id") * F.abs("id") * 1000).alias("b")).orderBy("id")
    buckets = [r.b for r in df.collect()]
    assert buckets == sorted(buckets)


def test_momentum_is_clamped_and_neutral(spark):
    rows = [(1.0, 30.0), (30.0, 1.0), (5.0, 6.0), (None, 4.0), (4.0, None)]
    df = spark.createDataFrame(rows, "now DOUBLE, before DOUBLE")
    got = [r[0] for r in df.select(S.momentum(F.col("before"), F.col("now"))).collect()]
    assert got == [100.0, 0.0, 55.0, 50.0, 50.0]


def test_trend_of_two_candidates(spark):
    rows = full_matrix(DAY)
    got = {r.full_name: r for r in R.trend_board(entries(spark, rows), DAY).collect()}
    new, old = got[FRESH], got[KNOWN]
    # 100 * .5 + 100 * .2 + 100 * .15 + 50 * .1 + 100 * .05
    assert (new.trend_score, new.trend_pass, new.rank_momentum, new.cross_period) == (95.0, True, 50.0, 100.0)
    assert (old.trend_score, old.trend_pass, old.previous_average_rank) == (10.0, False, None)


def test_previous_snapshot_is_one_date_strictly_before(spark):
    rows = [
        entry(date(2026, 8, 1), "go", "daily", 1, "a/b", 1),
        entry(BEFORE, "go", "daily", 9, "c/d", 1),
        entry(DAY, "go", "daily", 4, "a/b", 1),
        entry(DAY, "go", "daily", 5, "c/d", 2),
        entry(date(2026, 8, 30), "go", "daily", 1, "a/b", 1),
    ]
    got = {r.full_name: r for r in R.trend_board(entries(spark, rows), DAY).collect()}
    assert got["a/b"].rank_momentum == 50.0  # seen on an older date, but not in the previous snapshot
    assert got["c/d"].rank_momentum == 70.0
    assert {r.full_name for r in R.previous_snapshot(entries(spark, rows), DAY).collect()} == {"c/d"}
    assert R.previous_snapshot(entries(spark, rows), date(2026, 8, 1)).count() == 0


def test_pass_uses_the_unrounded_score(spark):
    parts = {
        "weekly_percentile": F.lit(39.99), "daily_percentile": F.lit(40.0), "monthly_percentile": F.lit(40.0),
        "rank_momentum": F.lit(40.0), "cross_period": F.lit(40.0),
    }
    exact = S.weighted(parts, P.TREND_WEIGHTS)
    row = spark.range(1).select(F.round(exact, 2).cast("double").alias("score"), (exact >= 40).alias("ok")).first()
    assert (row.score, row.ok) == (40.0, False)


@pytest.mark.parametrize(
    "present,values,winner",
    [(["daily", "weekly"], (50.0, 50.0, 99.0), "daily"), (["weekly", "monthly"], (99.0, 10.0, 20.0), "monthly"),
     ([], (10.0, 20.0, 20.0), "weekly"), (["daily", "monthly"], (10.0, None, None), "monthly")],
)
def test_primary_period(spark, present, values, winner):
    df = spark.createDataFrame(
        [(present, *values)],
        "periods_present ARRAY<STRING>, daily_percentile DOUBLE, weekly_percentile DOUBLE, monthly_percentile DOUBLE",
    )
    assert R.primary_period(df).first().primary_period == winner


def trend_rows(spark, *rows):
    schema = (
        "full_name STRING, trend_score DOUBLE, trend_pass BOOLEAN, weekly_percentile DOUBLE, daily_percentile DOUBLE,"
        " monthly_percentile DOUBLE, periods_present ARRAY<STRING>"
    )
    return spark.createDataFrame([(n, s, s >= 40, 50.0, 50.0, 50.0, ["daily"]) for n, s in rows], schema)


def with_total(block, total):
    return {**repository()[block], "total": total}


def test_waterfall_stages(spark):
    repos = [
        repository("a/ok"),
        repository("a/gate", hard_filter={**{g: True for g in P.GATES}, "readme_clear": False}, is_fork=True),
        repository("a/trend"),
        repository("a/quality", quality=with_total("quality", 59)),
        repository("a/value", value=with_total("value", 59)),
        repository("a/final", quality=with_total("quality", 60), value=with_total("value", 60)),
        repository("a/old", created="2020-01-01T00:00:00Z", language=None),
    ]
    trend = trend_rows(spark, *[(r["full_name"], 30.0 if r["full_name"] == "a/trend" else 60.0) for r in repos])
    got = {r.full_name: r for r in R.evaluate(repositories(spark, repos), trend, DAY).collect()}
    stage = {n: (r.status, r.rejection_stage, r.rejection_reasons) for n, r in got.items()}
    assert stage["a/ok"] == ("accepted", None, [])
    assert stage["a/gate"] == ("rejected", "hard_filter", ["is_fork", "readme_clear"])
    assert stage["a/trend"] == ("rejected", "trend", ["trend_score_below_40"])
    assert stage["a/quality"] == ("rejected", "quality", ["quality_score_below_60"])
    assert stage["a/value"] == ("rejected", "value", ["value_score_below_60"])
    assert stage["a/final"] == ("rejected", "final", ["final_score_below_65"])
    # the score and grade exist for rejected rows: 30 * .2 + 79 * .45 + 80 * .35
    assert (got["a/trend"].final_score, got["a/trend"].grade) == (69.55, "B")
    assert (got["a/ok"].hot_type, got["a/ok"].repository_age_days) == ("NEW_HOT", 39)
    assert (got["a/old"].hot_type, got["a/old"].language) == ("REVIVED_HOT", None)
    assert got["a/ok"].all_evidence_urls == sorted(set(got["a/ok"].all_evidence_urls))


def test_grades(spark):
    df = spark.createDataFrame([Row(s=x) for x in (85.0, 84.99, 75.0, 65.0, 64.99)])
    assert [r[0] for r in df.select(S.grade(F.col("s"))).collect()] == ["S", "A", "A", "B", None]


def test_small_fractions_spread_over_buckets(spark):
    values = spark.range(100_000).select((F.col("id") / 1e9).alias("v"))
    assert values.select(R.value_bucket(F.col("v"))).distinct().count() > 5000
    ordered = values.orderBy("v").select(R.value_bucket(F.col("v")).alias("b")).limit(2000).collect()
    assert [r.b for r in ordered] == sorted(r.b for r in ordered)


def test_null_population(spark):
    rows = [(None, 1, 10), (None, 2, 20), (None, 3, 30), ("a", 4, 5), ("a", 5, 6)]
    df = spark.createDataFrame(rows, "g STRING, i INT, v BIGINT")
    got = {r.i: r.percentile for r in R.midrank_percentile(df, ("g",), "v").collect()}
    assert got == {1: 0.0, 2: 50.0, 3: 100.0, 4: 0.0, 5: 100.0}


def test_one_idea_of_the_previous_capture(spark):
    """A capture in which every page failed is still the previous one."""
    early, failed = date(2026, 8, 13), BEFORE
    rows = [entry(early, "global", "daily", 9, "dock/a", 5), entry(failed, "global", "daily", 1, "dock/a", 5, status="failed"), entry(DAY, "global", "daily", 3, "dock/a", 5)]
    snapshots = entries(spark, rows)
    assert R.previous_snapshot_date(snapshots, DAY).first()[0] == failed
    assert R.momentum_join(snapshots, DAY).first().previous_rank is None
    assert R.trend_board(snapshots, DAY).first().rank_momentum == 50.0
