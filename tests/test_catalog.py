from datetime import date

from fixtures import repositories, repository
from pyspark.sql import functions as F
from test_ranking import trend_rows

from rankloom.operators import catalog as C
from rankloom.operators import edition as E
from rankloom.operators import ranking as R
from rankloom.operators.positions import with_position

D1, D2 = date(2026, 8, 27), date(2026, 8, 28)


def evaluations(spark, day, *repos, score=60.0):
    trend = trend_rows(spark, *[(r["full_name"], score) for r in repos])
    return R.evaluate(repositories(spark, list(repos)), trend, day)


def state(catalog):
    return sorted(tuple(r) for r in catalog.collect())


def test_upsert(spark):
    empty = spark.createDataFrame([], C.CATALOG_SCHEMA)
    first = C.catalog_upsert(empty, evaluations(spark, D1, repository("a/a"), repository("a/b"), repository("a/c")))
    later = evaluations(
        spark, D2, repository("a/a", language=None, category="Changed"), repository("a/b", is_fork=True), repository("a/d")
    )
    rows = {r.full_name: r for r in C.catalog_upsert(first, later).collect()}
    assert set(rows) == {"a/a", "a/b", "a/c", "a/d"}
    assert (rows["a/a"].first_accepted, rows["a/a"].last_evaluated) == (D1, D2)
    assert (rows["a/a"].language, rows["a/a"].category) == (None, "Changed")  # a null overwrites
    assert (rows["a/b"].last_evaluated, rows["a/c"].last_evaluated) == (D1, D1)  # rejected and absent rows stay
    assert (rows["a/d"].first_accepted, rows["a/d"].card) == (D2, "repos/a__d.md")


def test_repeated_batch_changes_nothing(spark):
    empty = spark.createDataFrame([], C.CATALOG_SCHEMA)
    batch = evaluations(spark, D1, repository("a/a"), repository("a/b"))
    once = C.catalog_upsert(empty, batch)
    assert state(once) == state(C.catalog_upsert(once, batch))
    # a rerun of the same date with another outcome replaces the fields
    again = C.catalog_upsert(once, evaluations(spark, D1, repository("a/a", category="New"), score=41.0))
    row = again.where("full_name = 'a/a'").first()
    assert (row.category, row.trend_score, row.first_accepted) == ("New", 41.0, D1)


def feature_case(spark):
    rows, catalog = [], []
    for p in ("daily", "weekly", "monthly"):
        for i in range(7):
            rows.append((f"x/{p}{i}", p, 80.0 + i))
            catalog.append((f"x/{p}{i}", D2))
    rows.append(("x/known", "daily", 99.0))
    catalog.append(("x/known", D1))
    ev = spark.createDataFrame(rows, "full_name STRING, primary_period STRING, final_score DOUBLE").select(
        "*", F.lit("accepted").alias("status"), F.lit(D2).alias("capture_date")
    )
    return ev, spark.createDataFrame(catalog, "full_name STRING, first_accepted DATE")


def test_features_are_capped_new_and_unique(spark):
    ev, catalog = feature_case(spark)
    rows = E.period_features(ev.union(ev.where("full_name = 'x/daily6'")), catalog, D2).collect()
    assert len(rows) == len({r.full_name for r in rows}) == 15
    assert [r.full_name for r in sorted(rows, key=lambda r: r.position) if r.period == "daily"] == [
        f"x/daily{i}" for i in (6, 5, 4, 3, 2)
    ]


def test_edition_record_follows_its_rules(spark):
    ev, catalog = feature_case(spark)
    record = E.edition_record(E.period_features(ev, catalog, D2), D2)
    row = E.edition_rules(record).first()
    assert row.violations == []
    assert row.displayed == row.featured["daily"] + row.featured["weekly"] + row.featured["monthly"]
    broken = record.withColumn("displayed", F.reverse("displayed")).withColumn("schema_version", F.lit(2))
    assert E.edition_rules(broken).first().violations == ["schema_version", "displayed"]
    empty = E.edition_record(E.period_features(ev, catalog, date(2026, 9, 9)), D2)
    assert E.edition_rules(empty).first().violations == []


def test_missing_evaluations_are_reported(spark):
    ev, catalog = feature_case(spark)
    features = E.period_features(ev, catalog, D2)
    found = E.feature_lookup(features, ev.where("full_name <> 'x/daily6'"))
    assert [r.full_name for r in found.where("missing").collect()] == ["x/daily6"]


def test_search(spark):
    rows = [("dock/knots", "Dock/Knots 绳结 图解 Forth", "手工", "Forth"), ("dock/tides", "dock/tides TIDE tables", "海洋", "Ada")]
    df = spark.createDataFrame(rows, "full_name STRING, search STRING, category STRING, language STRING")
    names = lambda *a, **k: sorted(r.full_name for r in C.catalog_search(df, *a, **k).collect())
    assert names("图解 dock") == ["dock/knots"] and names("tide Dock") == ["dock/tides"]
    assert names("") == ["dock/knots", "dock/tides"] and names("anchor") == []
    assert names("Ｔｉｄｅ　ＴＡＢＬＥＳ") == ["dock/tides"]
    assert names("", language="Ada") == ["dock/tides"] and names("knots", category="海洋") == []


def test_positions_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "g STRING, id INT")
    got = {r.id: r.position for r in with_position(df, [F.col("id")], ("g",), partitions=3).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 2}


def test_positions_over_hot_groups(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),
        (F.col("id") * 7919 % 13).alias("score"),
        F.col("id"),
    )
    got = {r.id: r.position for r in with_position(df, [F.desc("score"), F.col("id")], ("g",), partitions=7).collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault(r.g, []).append((-r.score, r.id))
    want = {i: n for rows in groups.values() for n, (_, i) in enumerate(sorted(rows), 1)}
    assert got == want
    flat = with_position(df, [F.desc("score"), F.col("id")], partitions=5).collect()
    assert sorted(r.position for r in flat) == list(range(1, 3001))
