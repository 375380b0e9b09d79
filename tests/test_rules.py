from datetime import date

import pytest
from fixtures import card, entries, entry, full_matrix, repositories, repository
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.operators import rules as U

DAY = date(2026, 8, 27)


def test_clean_rows_pass(spark):
    rows = U.page_rules(entries(spark, full_matrix(DAY)))
    assert rows.where("not valid").count() == 0
    assert U.duplicate_ranks(rows).count() == 0
    assert U.enrichment_rules(repositories(spark, [repository()])).first().violations == []


@pytest.mark.parametrize(
    "change,rule",
    [({"scope": "cobol"}, "scope"), ({"period": "yearly"}, "period"), ({"captured_at": "soon"}, "captured_at"),
     ({"raw_sha256": "a" * 63}, "raw_sha256"), ({"source_url": "https://mirror/x"}, "source_url"),
     ({"status": "failed"}, "failed_page_has_rows"), ({"rank": 0}, "rank"), ({"url": "https://mirror/a"}, "url"),
     ({"total_stars": -1}, "total_stars"), ({"period_stars": -1}, "period_stars"), ({"built_by": None}, "built_by")],
)
def test_page_rule(spark, change, rule):
    values = {"scope": "go", "period": "daily", "rank": 1, **{k: v for k, v in change.items() if k in ("scope", "period", "rank")}}
    rest = {k: v for k, v in change.items() if k not in values}
    row = entry(DAY, values["scope"], values["period"], values["rank"], "a/b", 1, **rest)
    assert U.page_rules(entries(spark, [row])).first().violations == [rule]


def test_missing_period_stars_are_no_violation(spark):
    assert U.page_rules(entries(spark, [entry(DAY, "go", "daily", 1, "a/b", None)])).first().valid


def test_repeated_rank(spark):
    rows = [entry(DAY, "go", "daily", 1, n, 1) for n in ("a/b", "a/c")]
    assert [r.rows for r in U.duplicate_ranks(entries(spark, rows)).collect()] == [2]


def change(block, **over):
    return {block: {**repository()[block], **over}}


@pytest.mark.parametrize(
    "over,rule",
    [({"url": "https://mirror/a"}, "url"), ({"created_at": "then"}, "created_at"), ({"is_fork": None}, "state_flags"),
     ({"hard_filter": {"readme_clear": True}}, "gate_keys"), (change("license", name=" "), "license_name"),
     (change("license", scope_zh="plain"), "license_scope"), (change("quality", total=78), "quality_total"),
     (change("quality", rationale=""), "quality_rationale"), (change("quality", evidence_urls=[]), "quality_evidence"),
     (change("value", level="P9"), "value_level"), ({"evidence_urls": ["https://mirror/x"]}, "evidence_urls")],
)
def test_enrichment_rule(spark, over, rule):
    assert U.enrichment_rules(repositories(spark, [repository(**over)])).first().violations == [rule]


def test_component_limits(spark):
    scores = {**repository()["quality"]["scores"], "dependency_transparency": 6}
    over = repository(**change("quality", scores=scores, total=81))
    missing = repository("a/b", **change("quality", scores={"tests_ci_release": 3}, total=3))
    rows = U.component_total(repositories(spark, [over, missing]), "quality", P.QUALITY_LIMITS).collect()
    assert [(r.component_total, r.in_range, r.total_matches) for r in rows] == [(81, False, True), (3, False, True)]


def lint(spark, **over):
    df = repositories(spark, [repository(card=card("demo", **over))])
    return U.text_lint_rules(df, U.card_fields()).first().violations


def test_card_lint(spark):
    assert lint(spark) == []
    assert lint(spark, features=["包含明确的依赖或构建清单", "汇总结果"]) == ["features_phrase"]
    assert lint(spark, features=["只有一条"]) == ["features_items"]
    assert lint(spark, usage="先阅读 README 再运行") == ["usage_pattern_1"]
    assert lint(spark, audience=["评估技术方案的团队"]) == ["audience_pattern_2"]
    assert lint(spark, what="Only English") == ["what_native"]
    assert lint(spark, why=" ") == ["why_empty", "why_native"]
    long = "这是 " + "A long clause of foreign words that goes on without any end " * 2
    assert lint(spark, value=long) == ["value_native"]


@pytest.mark.parametrize("length,native", [(60, True), (61, False)])
def test_foreign_run_boundary(spark, length, native):
    texts = ["中" + "a" * length + "文", "中 12 " + "b" * length + "文"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert [r.native for r in U.native_script_rule(df, "t").collect()] == [native, native]


def test_foreign_run_against_plain_pattern(spark):
    import random
    import re

    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab 1,é\n-") for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    from rankloom.functions.text import has_foreign_run

    got = [r[0] for r in df.select(has_foreign_run(F.col("t"), 6)).collect()]
    assert got == [bool(re.search(r"[A-Za-z][A-Za-z0-9 ,.'’\-–—/:()]{6,}", t)) for t in texts]


def test_repeated_cards(spark):
    same = {"features": ["Do  THIS", "And that "], "strengths": ["x", "y"]}
    other = {"features": ["do this", "and that"], "strengths": ["y", "x"]}
    repos = [repository(f"a/{i}", card=card("n", **(same if i % 3 else other))) for i in range(30)]
    repos.append(repository("b/own"))
    df = repositories(spark, repos)
    rows = U.duplicate_fingerprints(df, "full_name", F.col("card.features")).collect()
    assert {r.members for r in rows} == {30} and len(rows) == 30
    assert [r.member for r in rows] == sorted(r.member for r in rows)
    summary = U.audit_summary(df, "full_name", {f: F.col(f"card.{f}") for f in ("features", "strengths")}, ("features", "strengths"), script=None).first()
    assert (summary.rows, summary.invalid_rows) == (31, 30)
    assert (summary.duplicate_features_sets, summary.duplicate_strengths_sets) == (1, 2)


def test_matrix_and_pool(spark):
    pages = spark.createDataFrame([("go", "daily"), ("go", "daily"), ("x", "daily")], "scope STRING, period STRING")
    wanted = spark.createDataFrame([("go", "daily"), ("rust", "daily")], "scope STRING, period STRING")
    got = {r.scope: (r.pages, r.outcome) for r in U.matrix_coverage(pages, wanted).collect()}
    assert got == {"go": (2, "repeated"), "x": (1, "unexpected"), "rust": (0, "missing")}
    a = spark.createDataFrame([("p",), ("q",)], "full_name STRING")
    b = spark.createDataFrame([("q",), ("r",)], "full_name STRING")
    assert {(r.full_name, r.side) for r in U.pool_reconcile(a, b).collect()} == {("p", "missing"), ("r", "extra")}


def test_sections(spark):
    text = "\n".join(P.REQUIRED_CARD_HEADINGS)
    df = spark.createDataFrame([(text,), (text.replace("## 适合谁", "") + "## 核心调用链",)], "t STRING")
    good, bad = U.section_rules(df, "t").collect()
    assert good.valid and (bad.missing_sections, bad.forbidden_sections) == (["## 适合谁"], ["## 核心调用链"])
