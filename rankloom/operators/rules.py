"""Validation as rule columns: every row gets the list of the rules it breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions.scalars import (
    canonical_url,
    components_in_range,
    map_total,
    parse_timestamp_utc,
    same_keys,
    violations,
)
from rankloom.functions.text import contains_any, fold_whitespace, native_explanation
from rankloom.session import stored


def page_rules(entries: DataFrame, scopes: tuple[str, ...] = P.SCOPES, site: str = P.SITE) -> DataFrame:
    """Rules on exploded page rows; the row rules are silent for a page without rows (null rank)."""
    has_row = F.col("rank").isNotNull()
    rules = violations(
        (~F.col("scope").isin(*scopes), "scope"),
        (~F.col("period").isin(*P.PERIODS), "period"),
        (~F.col("status").isin("success", "failed"), "status"),
        (parse_timestamp_utc(F.col("captured_at")).isNull(), "captured_at"),
        (~F.col("raw_sha256").rlike("^[A-Fa-f0-9]{64}$"), "raw_sha256"),
        (~F.startswith("source_url", F.lit(site + P.BOARD_PATH)), "source_url"),
        ((F.col("status") == "failed") & has_row, "failed_page_has_rows"),
        (has_row & (F.col("rank") < 1), "rank"),
        (has_row & (F.col("url") != canonical_url(F.col("full_name"), site)), "url"),
        (has_row & (F.coalesce("total_stars", F.lit(-1)) < 0), "total_stars"),
        (has_row & (F.coalesce("total_forks", F.lit(-1)) < 0), "total_forks"),
        (has_row & (F.col("period_stars") < 0), "period_stars"),
        (has_row & F.col("built_by").isNull(), "built_by"),
    )
    return entries.withColumn("violations", rules).withColumn("valid", F.size("violations") == 0)


def duplicate_ranks(entries: DataFrame, page: tuple[str, ...] = ("capture_date", "scope", "period")) -> DataFrame:
    return entries.groupBy(*page, "rank").agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def matrix_coverage(pages: DataFrame, expected: DataFrame) -> DataFrame:
    """Pages of the expected (scope, period) set that are absent or repeated, and pages beyond it."""
    counted = pages.groupBy("scope", "period").agg(F.count("*").alias("pages"))
    wanted = expected.select("scope", "period").withColumn("expected", F.lit(True))
    joined = counted.join(wanted, ["scope", "period"], "full_outer")
    outcome = (
        F.when(F.col("expected").isNull(), "unexpected").when(F.col("pages").isNull(), "missing").when(
            F.col("pages") > 1, "repeated"
        )
    )
    return (
        joined.withColumn("outcome", outcome)
        .withColumn("pages", F.coalesce("pages", F.lit(0)))
        .where(F.col("outcome").isNotNull())
        .select("scope", "period", "pages", "outcome")
    )


def expected_set_equality(actual: DataFrame, expected: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row: number of missing and extra keys, and whether the sets are equal."""
    diff = symmetric_difference(actual.select(*keys), expected.select(*keys))
    return diff.agg(
        F.count_if(F.col("side") == "missing").alias("missing"), F.count_if(F.col("side") == "extra").alias("extra")
    ).withColumn("equal", (F.col("missing") == 0) & (F.col("extra") == 0))


def duplicate_keys(rows: DataFrame, key: str = "full_name") -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def symmetric_difference(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Distinct keys on one side only: ``missing`` from actual, or ``extra`` in it.

    One aggregate over both sides; repeated keys are combined before the shuffle."""
    tagged = actual.withColumn("_a", F.lit(1)).withColumn("_e", F.lit(0)).unionByName(
        expected.withColumn("_a", F.lit(0)).withColumn("_e", F.lit(1))
    )
    sides = tagged.groupBy(*actual.columns).agg(F.max("_a").alias("_a"), F.max("_e").alias("_e"))
    one_sided = sides.where(F.col("_a") != F.col("_e"))
    return one_sided.withColumn("side", F.when(F.col("_a") == 1, "extra").otherwise("missing")).drop("_a", "_e")


def pool_reconcile(candidates: DataFrame, enrichment: DataFrame, key: str = "full_name") -> DataFrame:
    """Candidates without enrichment (missing) and enrichment without candidate (extra)."""
    return symmetric_difference(enrichment.select(key), candidates.select(key))


def pool_counts(candidates: DataFrame, enrichment: DataFrame, declared_raw: Column, declared_evaluated: Column, key: str = "full_name") -> DataFrame:
    """Declared against actual counts of a batch, in one row."""
    tagged = candidates.select(key).distinct().withColumn("_raw", F.lit(1)).unionByName(
        enrichment.select(key).withColumn("_raw", F.lit(0))
    )
    actual = tagged.agg(
        F.coalesce(F.sum("_raw"), F.lit(0)).alias("raw_candidates"), F.count_if(F.col("_raw") == 0).alias("evaluated")
    )
    return actual.withColumn("raw_match", F.col("raw_candidates") == declared_raw).withColumn(
        "evaluated_match", F.col("evaluated") == declared_evaluated
    )


def snapshot_counts(snapshots: DataFrame, declared: str = "declared", items: str = "items") -> DataFrame:
    """Snapshots whose declared count is not the size of their nested list."""
    actual = F.coalesce(F.size(items), F.lit(0))
    return snapshots.withColumn("actual", actual).where(F.coalesce(F.col(declared), F.lit(-1)) != F.col("actual"))


# --- enrichment ---------------------------------------------------------------------------


def blank(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit("")) == ""


def no_items(items: Column) -> Column:
    return F.coalesce(F.size(items), F.lit(0)) <= 0


def evidence_url_failure(*arrays: Column, site: str = P.SITE) -> Column:
    """No URL at all, or one without the required prefix."""
    urls = F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays])
    wrong = F.exists(urls, lambda u: ~F.coalesce(F.startswith(u, F.lit(site + "/")), F.lit(False)))
    return (F.size(urls) == 0) | wrong


def all_evidence() -> tuple[Column, ...]:
    return tuple(F.col(c) for c in ("evidence_urls", "license.evidence_urls", "quality.evidence_urls", "value.evidence_urls"))


def enrichment_rules(enrichment: DataFrame, script: str = P.NATIVE_SCRIPT, site: str = P.SITE) -> DataFrame:
    rules = violations(
        (F.col("url") != canonical_url(F.col("full_name"), site), "url"),
        (parse_timestamp_utc(F.col("created_at")).isNull(), "created_at"),
        (parse_timestamp_utc(F.col("pushed_at")).isNull(), "pushed_at"),
        (F.col("is_fork").isNull() | F.col("is_mirror").isNull() | F.col("archived").isNull(), "state_flags"),
        (~F.coalesce(same_keys(F.col("hard_filter"), P.GATES), F.lit(False)), "gate_keys"),
        (F.exists(F.map_values("hard_filter"), lambda v: v.isNull()), "gate_values"),
        (blank(F.col("license.name")), "license_name"),
        (~F.coalesce(F.col("license.scope_zh").rlike(f"[{script}]"), F.lit(False)), "license_scope"),
        (F.col("license.evidence_urls").isNull(), "license_evidence"),
        (~F.coalesce(components_in_range(F.col("quality.scores"), P.QUALITY_LIMITS), F.lit(False)), "quality_scores"),
        (map_total(F.col("quality.scores")) != F.col("quality.total"), "quality_total"),
        (blank(F.col("quality.rationale")), "quality_rationale"),
        (no_items(F.col("quality.evidence_urls")), "quality_evidence"),
        (~F.coalesce(components_in_range(F.col("value.scores"), P.VALUE_LIMITS), F.lit(False)), "value_scores"),
        (map_total(F.col("value.scores")) != F.col("value.total"), "value_total"),
        (~F.coalesce(F.col("value.level").isin(*P.VALUE_LEVELS), F.lit(False)), "value_level"),
        (blank(F.col("value.rationale")), "value_rationale"),
        (no_items(F.col("value.evidence_urls")), "value_evidence"),
        (evidence_url_failure(*all_evidence(), site=site), "evidence_urls"),
    )
    return enrichment.withColumn("violations", rules).withColumn("valid", F.size("violations") == 0)


def evidence_url_rule(enrichment: DataFrame, site: str = P.SITE) -> DataFrame:
    total = sum((F.coalesce(F.size(a), F.lit(0)) for a in all_evidence()), F.lit(0))
    return enrichment.withColumn("url_count", total).withColumn(
        "valid", ~evidence_url_failure(*all_evidence(), site=site)
    )


def component_total(enrichment: DataFrame, block: str, limits: dict[str, int]) -> DataFrame:
    scores = F.col(f"{block}.scores")
    return enrichment.select(
        "full_name",
        F.lit(block).alias("block"),
        map_total(scores).alias("component_total"),
        F.coalesce(components_in_range(scores, limits), F.lit(False)).alias("in_range"),
        (map_total(scores) == F.col(f"{block}.total")).alias("total_matches"),
    )


# --- card texts -----------------------------------------------------------------------------


def native_script_rule(df: DataFrame, text: str, script: str = P.NATIVE_SCRIPT, run: int = P.CARD_FOREIGN_RUN_MIN) -> DataFrame:
    return df.withColumn("native", F.coalesce(native_explanation(F.col(text), script, run), F.lit(False)))


def lint_rules(
    fields: dict[str, Column],
    phrases: dict[str, tuple[str, ...]] = P.FORBIDDEN_PHRASES,
    patterns: dict[str, tuple[str, ...]] = P.FORBIDDEN_PATTERNS,
    min_items: dict[str, int] = P.MIN_ITEMS,
    script: str | None = P.NATIVE_SCRIPT,
    run: int = P.CARD_FOREIGN_RUN_MIN,
) -> list[tuple[Column, str]]:
    """(condition, name) pairs over list-valued fields; wrap a scalar field as a one-item list.

    The rule tables are parameters of the plan, so each row is checked where it lies."""
    out: list[tuple[Column, str]] = []
    for name, items in fields.items():
        out.append((no_items(items) | F.exists(items, blank), f"{name}_empty"))
        if script:
            foreign = F.exists(items, lambda x: ~F.coalesce(native_explanation(x, script, run), F.lit(False)))
            out.append((foreign, f"{name}_native"))
        if name in min_items:
            out.append((F.coalesce(F.size(items), F.lit(0)) < min_items[name], f"{name}_items"))
        if phrases.get(name):
            out.append((F.exists(items, _contains(phrases[name])), f"{name}_phrase"))
        for number, pattern in enumerate(patterns.get(name, ()), 1):
            out.append((F.exists(items, _matches(pattern)), f"{name}_pattern_{number}"))
    return out


def _contains(phrases: tuple[str, ...]):
    return lambda text: contains_any(text, phrases)


def _matches(pattern: str):
    return lambda text: text.rlike("(?i)" + pattern)


def card_fields(card: str = "card") -> dict[str, Column]:
    fields = {name: F.array(F.col(f"{card}.{name}")) for name in P.CARD_SCALAR_FIELDS}
    fields.update({name: F.col(f"{card}.{name}") for name in P.CARD_LIST_FIELDS})
    return fields


def text_lint_rules(df: DataFrame, fields: dict[str, Column], **options) -> DataFrame:
    linted = df.withColumn("violations", violations(*lint_rules(fields, **options)))
    return linted.withColumn("valid", F.size("violations") == 0)


def section_rules(
    df: DataFrame,
    text: str,
    required: tuple[str, ...] = P.REQUIRED_CARD_HEADINGS,
    forbidden: tuple[str, ...] = P.FORBIDDEN_CARD_HEADINGS,
) -> DataFrame:
    """Required phrases that are absent and forbidden phrases that are present."""
    body = F.coalesce(F.col(text), F.lit(""))
    missing = F.array_compact(F.array(*[F.when(~F.contains(body, F.lit(p)), F.lit(p)) for p in required]))
    present = F.array_compact(F.array(*[F.when(F.contains(body, F.lit(p)), F.lit(p)) for p in forbidden]))
    checked = df.withColumn("missing_sections", missing).withColumn("forbidden_sections", present)
    return checked.withColumn("valid", (F.size("missing_sections") == 0) & (F.size("forbidden_sections") == 0))


# --- repeated texts ---------------------------------------------------------------------------


def fingerprint(items: Column) -> Column:
    """Digest of the folded items; a separator that folding removes keeps item limits apart."""
    return F.sha2(F.array_join(F.transform(items, fold_whitespace), "\n"), 256)


def fingerprint_table(df: DataFrame, key: str, **lists: Column) -> DataFrame:
    """(key, digest per list), written once: the texts are read a single time, and what is
    counted and looked up afterwards is a narrow table."""
    prints = df.select(F.col(key), *[fingerprint(items).alias(name) for name, items in lists.items()])
    return stored(prints, "fingerprints")


def fingerprint_groups(prints: DataFrame, key: str, name: str = "fingerprint") -> DataFrame:
    """Repeated digests with size and smallest key. Combined per task before the shuffle, so a
    group with a third of the rows is one row per task; no group's members are gathered."""
    groups = prints.groupBy(name).agg(F.count("*").alias("members"), F.min(key).alias("first_member"))
    return groups.where(F.col("members") > 1)


def duplicate_fingerprints(df: DataFrame, key: str, items: Column) -> DataFrame:
    """Members of every repeated group, one per row, largest groups first, then by name.

    The lookup's right side is unique by digest, so the adaptive skew join can split the rows
    of a large group over tasks.
    """
    prints = fingerprint_table(df, key, fingerprint=items)
    members = prints.join(fingerprint_groups(prints, key), "fingerprint").withColumnRenamed(key, "member")
    return members.orderBy(F.desc("members"), "first_member", "fingerprint", "member")


def audit_summary(df: DataFrame, key: str, fields: dict[str, Column], repeated: tuple[str, ...], **options) -> DataFrame:
    """One row: rows, invalid rows (rule failures or members of a repeated group), groups per field."""
    broken = F.lit(False)
    for condition, _ in lint_rules(fields, **options):
        broken = broken | F.coalesce(condition, F.lit(False))
    digests = [fingerprint(fields[f]).alias(f"print_{f}") for f in repeated]
    rows = stored(df.select(F.col(key), broken.alias("broken"), *digests), "audit")
    joined, copied = rows, F.lit(False)
    for f in repeated:
        groups = fingerprint_groups(rows, key, f"print_{f}").select(
            f"print_{f}", F.col("members").alias(f"members_{f}"), F.col("first_member").alias(f"first_{f}")
        )
        joined = joined.join(groups, f"print_{f}", "left")
        copied = copied | F.col(f"members_{f}").isNotNull()
    # a group is counted at its first member, so no distinct count over all rows is needed
    return joined.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("broken") | copied).alias("invalid_rows"),
        *[F.count_if(F.col(f"first_{f}") == F.col(key)).alias(f"duplicate_{f}_sets") for f in repeated],
    )


def issue_sample(issues: DataFrame, order: list[str], limit: int = 20) -> DataFrame:
    """The first ``limit`` issues in a fixed order (a top-k, not a sort of all), with the total."""
    total = issues.agg(F.count("*").alias("total")).scalar()
    return issues.orderBy(*order).limit(limit).withColumn("total", total)
