"""Registered queries: one per operator, over whole tables. Arrays are shown as joined text."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions import scalars as S
from rankloom.functions import text as X
from rankloom.operators import boards as B
from rankloom.operators import catalog as C
from rankloom.operators import digest_tree as T
from rankloom.operators import documents as D
from rankloom.operators import edition as E
from rankloom.operators import evidence as V
from rankloom.operators import links as L
from rankloom.operators import manifests as M
from rankloom.operators import ranking as R
from rankloom.operators import references as A
from rankloom.operators import rules as U
from rankloom.plans import views as W
from rankloom.plans.views import SCRIPT
from rankloom.session import run_folder, stored
from rankloom.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FORBIDDEN_WORDS = {"body": ("###", "$$$"), "first": ("the the",)}
FORBIDDEN_SHAPES = {"body": (r"\btoken\s*=", r"[%]{3}\s"), "first": (r"^the\b",)}
LINT_MIN_ITEMS = {"body": 2}
REQUIRED_PARTS = ("# Item", "## Usage", "## Notes")
FORBIDDEN_PARTS = ("TODO_TRANSLATE", "### ")


def register(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return run


def joined(column: Column | str, by: str = ",") -> Column:
    return F.array_join(column, by)


# --- boards -----------------------------------------------------------------------------


@register
def board_matrix(spark, folder):
    return B.board_matrix(W.scopes(spark, folder))


@register
def board_entries(spark, folder):
    return W.board_entries(spark, folder).select(
        "capture_date", "scope", "period", "rank", "full_name", "period_stars", "total_stars", "total_forks"
    )


@register
def parse_pages(spark, folder):
    parsed = B.parse_boards(W.board_html(spark, folder))
    return B.parsed_entries(parsed, "page_id").withColumn("built_by", joined("built_by"))


@register
def board_rank(spark, folder):
    parsed = B.parse_boards(W.board_html(spark, folder))
    return B.parsed_entries(parsed, "page_id").select("page_id", "rank", "full_name")


@register
def page_status(spark, folder):
    return B.page_status(B.parse_boards(W.board_html(spark, folder)), "page_id")


@register
def page_hash_manifest(spark, folder):
    return B.page_hash_manifest(read_table(spark, folder, "pages"), "page_id", "html")


@register
def success_pages_only(spark, folder):
    rows = B.success_pages_only(W.board_entries(spark, folder))
    return rows.groupBy("capture_date", "scope", "period").agg(F.count("*").alias("entries"), F.max("rank").alias("last_rank"))


@register
def consolidate(spark, folder):
    return B.consolidate(W.board_entries(spark, folder))


@register
def appearances(spark, folder):
    return B.appearances(W.board_entries(spark, folder))


@register
def average_rank(spark, folder):
    return B.average_rank(W.board_entries(spark, folder))


@register
def period_max_pivot(spark, folder):
    return B.period_max_pivot(W.board_entries(spark, folder))


@register
def cross_period(spark, folder):
    return B.cross_period(W.board_entries(spark, folder)).withColumn("periods_present", joined("periods_present"))


@register
def distinct_candidates(spark, folder):
    return B.distinct_candidates(W.board_entries(spark, folder))


@register
def name_order(spark, folder):
    from rankloom.operators.positions import with_position

    names = B.distinct_candidates(W.board_entries(spark, folder))
    return with_position(names, [F.lower("full_name"), F.col("full_name")])


@register
def collection_summary(spark, folder):
    entries = W.snapshots(spark, folder)
    today = entries.where(F.col("capture_date") == F.lit(W.capture(spark, folder)))
    requests = V.evidence_requests(B.distinct_candidates(today), W.KINDS)
    reuse = V.evidence_asof_reuse(requests, W.evidence(spark, folder), W.capture(spark, folder))
    # in place of a fetch: kind "view" of names ending in 7 is taken as failed
    failed = ~F.col("reused") & (F.col("kind") == "view") & F.endswith("full_name", F.lit("7"))
    return B.collection_summary(
        W.board_pages(today), today, reuse.withColumn("status", F.when(failed, "failed").otherwise("success"))
    )


# --- scoring ----------------------------------------------------------------------------


@register
def previous_snapshot(spark, folder):
    rows = R.previous_snapshot(W.snapshots(spark, folder), W.capture(spark, folder))
    return rows.select("capture_date", "scope", "period", "rank", "full_name")


@register
def momentum_join(spark, folder):
    rows = R.momentum_join(W.snapshots(spark, folder), W.capture(spark, folder))
    ranks = [S.round2(F.col(c)).alias(c) for c in ("current_rank", "previous_rank", "rank_momentum")]
    return rows.select("full_name", *ranks)


@register
def rank_momentum(spark, folder):
    return R.trend_board(W.snapshots(spark, folder), W.capture(spark, folder)).select(
        "full_name", "average_rank", "previous_average_rank", "rank_momentum"
    )


@register
def midrank_percentile(spark, folder):
    """Over all event totals per user and type, ties and missing values included."""
    totals = W.board_events(spark, folder).groupBy("scope", "item").agg(F.sum("metric").alias("metric"))
    coarse = totals.withColumn("metric", F.when(F.col("item") % 9 != 4, F.expr("metric div 5000")))
    ranked = R.midrank_percentile(coarse, ("scope",), "metric")
    return ranked.select("scope", "item", "metric", S.round2(F.col("percentile")).alias("percentile"))


@register
def trend_score(spark, folder):
    return R.trend_board(W.snapshots(spark, folder), W.capture(spark, folder)).select(
        "full_name", *P.TREND_WEIGHTS, "trend_score", "trend_pass"
    )


@register
def trend_board(spark, folder):
    rows = R.trend_board(W.snapshots(spark, folder), W.capture(spark, folder))
    return rows.withColumn("periods_present", joined("periods_present"))


@register
def hard_filter(spark, folder):
    rows = R.hard_filter(W.enrichment(spark, folder))
    return rows.select("full_name", joined("gate_failures").alias("gate_failures"), "gate_pass")


@register
def primary_period(spark, folder):
    rows = R.primary_period(R.trend_board(W.snapshots(spark, folder), W.capture(spark, folder)))
    return rows.select("full_name", "primary_period")


@register
def candidate_enrichment(spark, folder):
    batch = W.Batch(spark, folder)
    rows = R.candidate_enrichment(batch.trend, batch.enrichment)
    return rows.select("full_name", "category", "language", "trend_score", F.col("quality.total").alias("quality_score"))


@register
def final_score(spark, folder):
    return W.Batch(spark, folder).current.select("full_name", "final_score")


@register
def grade(spark, folder):
    return W.Batch(spark, folder).evaluations.select("capture_date", "full_name", "final_score", "grade")


@register
def evaluate_waterfall(spark, folder):
    return W.Batch(spark, folder).evaluations.select(
        "capture_date", "full_name", "trend_score", "final_score", "grade", "status", "rejection_stage",
        joined("rejection_reasons").alias("rejection_reasons"),
    )


@register
def evidence_union(spark, folder):
    return W.enrichment(spark, folder).select("full_name", joined(R.evidence_union()).alias("evidence_urls"))


@register
def component_total(spark, folder):
    rows = W.enrichment(spark, folder)
    return U.component_total(rows, "quality", P.QUALITY_LIMITS).unionByName(
        U.component_total(rows, "value", P.VALUE_LIMITS)
    )


# --- catalog ----------------------------------------------------------------------------


@register
def catalog_upsert(spark, folder):
    return W.Batch(spark, folder).catalog()


@register
def first_accepted(spark, folder):
    return C.first_accepted(W.Batch(spark, folder).evaluations)


@register
def newly_accepted(spark, folder):
    batch = W.Batch(spark, folder)
    return C.newly_accepted(batch.current, batch.catalog(), batch.day).select("full_name", "final_score")


@register
def catalog_order(spark, folder):
    return C.catalog_order(W.Batch(spark, folder).catalog()).select("position", "full_name", "final_score")


@register
def accepted_order(spark, folder):
    return C.accepted_order(W.Batch(spark, folder).current)


@register
def per_period_index(spark, folder):
    rows = C.per_period_index(W.Batch(spark, folder).catalog())
    return rows.select("period", "position", "full_name", "grade", "final_score", "trend_score", "quality_score", "value_score")


@register
def catalog_search(spark, folder):
    rows = read_table(spark, folder, "customer").join(
        read_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    search = C.search_text(F.col("c_name"), F.col("c_mktsegment"), F.col("n_name"))
    listed = rows.select("c_name", F.col("c_mktsegment").alias("category"), F.col("n_name").alias("language"), search.alias("search"))
    found = C.catalog_search(listed, " CUSTOMER  machin 1 ", category="MACHINERY")
    return found.select("c_name", "category", "language")


@register
def facets(spark, folder):
    return C.facets(W.Batch(spark, folder).catalog())


@register
def latest_attribute(spark, folder):
    """Newest event type of each user as of whole days; a missing one becomes the label."""
    days = read_table(spark, folder, "events").groupBy(
        W.item_name(F.col("user_id")).alias("full_name"), F.to_date("ts").alias("capture_date")
    ).agg(F.max("event_type").alias("language"))
    return C.latest_attribute(days.withColumn("language", F.when(F.col("language") != "signup", F.col("language"))))


@register
def detail_join(spark, folder):
    batch = W.Batch(spark, folder)
    docs = W.docs_md(spark, folder)
    summaries = docs.select(
        W.item_name(F.col("doc_id")).alias("full_name"), X.first_paragraph(X.section(F.col("md"), "Summary")).alias("one_line")
    )
    languages = batch.enrichment.where(F.col("language").isNotNull()).select("full_name", F.upper("language").alias("language"))
    return C.detail_join(batch.catalog(), summaries, languages)


@register
def normalized_projection(spark, folder):
    return C.normalized_projection(W.Batch(spark, folder).evaluations)


@register
def history_desc(spark, folder):
    return C.history_desc(read_table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("capture_date")))


# --- edition ----------------------------------------------------------------------------


@register
def period_features(spark, folder):
    return W.Batch(spark, folder).features()


@register
def edition_stats(spark, folder):
    batch = W.Batch(spark, folder)
    return E.edition_stats(batch.pages, batch.trend, batch.current, batch.catalog(), batch.day)


@register
def daily_edition(spark, folder):
    """The edition record as rows: each displayed key with its period and display number."""
    record = E.edition_record(W.Batch(spark, folder).features(), W.capture(spark, folder))
    shown = record.select("date", "featured", F.posexplode("displayed").alias("p", "full_name"))
    period = F.coalesce(
        *[F.when(F.array_contains(F.element_at("featured", F.lit(p)), F.col("full_name")), F.lit(p)) for p in P.PERIODS]
    )
    return shown.select("date", (F.col("p") + 1).alias("display_no"), period.alias("period"), "full_name")


@register
def daily_report(spark, folder):
    batch = W.Batch(spark, folder)
    return E.daily_report(E.period_features(batch.current, batch.catalog(), batch.day), batch.current)


def edition_rows(spark, folder) -> DataFrame:
    """An edition per day of events: the busiest users of three event types, a few of them altered."""
    totals = W.board_events(spark, folder).groupBy(F.to_date("ts").alias("date"), "scope", "item").agg(F.sum("metric").alias("m"))
    from pyspark.sql import Window

    order = Window.partitionBy("date", "scope").orderBy(F.desc("m"), "item")
    top = totals.withColumn("n", F.row_number().over(order)).where(F.col("n") <= P.FEATURES_PER_PERIOD)
    kinds = {"daily": "click", "weekly": "purchase", "monthly": "view"}
    lists = top.groupBy("date").agg(
        *[
            F.array_sort(F.collect_list(F.when(F.col("scope") == s, F.struct("n", W.item_name(F.col("item")).alias("name"))))).alias(p)
            for p, s in kinds.items()
        ]
    )
    names = [F.transform(p, lambda r: r["name"]) for p in kinds]
    day = F.dayofmonth("date")
    shown = F.flatten(F.array(*names))
    return lists.select(
        "date",
        F.when(day % 10 == 3, 2).otherwise(1).alias("schema_version"),
        F.map_from_arrays(
            F.array(F.lit("daily"), F.lit("weekly"), F.when(day % 10 == 6, F.lit("yearly")).otherwise(F.lit("monthly"))),
            F.array(*names),
        ).alias("featured"),
        F.when(day % 10 == 8, F.reverse(shown)).otherwise(shown).alias("displayed"),
    )


@register
def edition_rules(spark, folder):
    rows = E.edition_rules(edition_rows(spark, folder))
    return rows.select("date", joined("displayed").alias("displayed"), joined("violations").alias("violations"))


@register
def displayed_union(spark, folder):
    return E.displayed_union(edition_rows(spark, folder))


@register
def coverage_subset(spark, folder):
    return M.coverage_subset(E.displayed_union(edition_rows(spark, folder)), W.Batch(spark, folder).catalog())


@register
def feature_lookup(spark, folder):
    shown = edition_rows(spark, folder).select(F.lit(W.capture(spark, folder)).alias("capture_date"), F.explode("displayed").alias("full_name"))
    return E.feature_lookup(shown.distinct(), W.Batch(spark, folder).current)


# --- rules ------------------------------------------------------------------------------


@register
def page_rules(spark, folder):
    rows = U.page_rules(W.altered_entries(W.board_entries(spark, folder)), scopes=W.SCOPES[:-1])
    return rows.select("capture_date", "scope", "period", "full_name", joined("violations").alias("violations"), "valid")


@register
def duplicate_ranks(spark, folder):
    return U.duplicate_ranks(W.altered_entries(W.board_entries(spark, folder)))


@register
def matrix_coverage(spark, folder):
    """Each capture's pages put together, against the wanted matrix with one scope more."""
    pages = W.board_pages(W.snapshots(spark, folder)).where(F.col("scope") != "view")
    wanted = B.board_matrix(W.scopes(spark, folder)).where(F.col("scope") != "click")
    return U.matrix_coverage(pages, wanted)


@register
def expected_set_equality(spark, folder):
    pages = W.board_pages(W.board_entries(spark, folder)).where(F.col("status") == "success")
    return U.expected_set_equality(pages, B.board_matrix(W.scopes(spark, folder)), ("scope", "period"))


@register
def duplicate_keys(spark, folder):
    rows = W.enrichment(spark, folder).select("full_name").unionByName(
        B.distinct_candidates(W.board_entries(spark, folder))
    )
    return U.duplicate_keys(rows)


@register
def pool_reconcile(spark, folder):
    batch = W.Batch(spark, folder)
    return U.pool_reconcile(B.distinct_candidates(batch.entries), batch.enrichment.where(F.col("item") % 40 != 39))


@register
def pool_counts(spark, folder):
    batch = W.Batch(spark, folder)
    today = batch.entries.where(F.col("capture_date") == F.lit(batch.day))
    declared = today.select(F.countDistinct("full_name")).scalar(), batch.enrichment.select(F.count("*")).scalar()
    return U.pool_counts(batch.trend, batch.enrichment.where(F.col("item") % 40 != 39), *declared)


@register
def symmetric_difference(spark, folder):
    entries = W.snapshots(spark, folder)
    names = lambda day: entries.where(F.col("capture_date") == F.lit(day)).select("full_name")
    return U.symmetric_difference(names(W.capture(spark, folder)), names(W.prior(spark, folder)))


@register
def enrichment_rules(spark, folder):
    rows = U.enrichment_rules(W.enrichment(spark, folder), SCRIPT)
    return rows.select("full_name", joined("violations").alias("violations"), "valid")


@register
def evidence_url_rule(spark, folder):
    return U.evidence_url_rule(W.enrichment(spark, folder)).select("full_name", "url_count", "valid")


@register
def snapshot_counts(spark, folder):
    """Documents as snapshots of their lines; some declare one line more than they have."""
    docs = W.documents(spark, folder).select("doc_id", F.split("text", "\n").alias("items"))
    declared = F.size("items") + W.when_mod(F.col("doc_id"), 5, 2, 1, 0)
    return U.snapshot_counts(docs.withColumn("declared", declared)).select("doc_id", "declared", "actual")


def doc_lines(spark, folder) -> DataFrame:
    docs = W.documents(spark, folder)
    return docs.select("doc_id", "text", F.split("text", "\n").alias("lines"))


def lint_fields() -> dict[str, Column]:
    return {"first": F.array(F.col("lines")[0]), "body": F.col("lines")}


LINT = {"phrases": FORBIDDEN_WORDS, "patterns": FORBIDDEN_SHAPES, "min_items": LINT_MIN_ITEMS, "script": None}


@register
def native_script_rule(spark, folder):
    return U.native_script_rule(W.documents(spark, folder), "text", SCRIPT).select("doc_id", "native")


@register
def text_lint_rules(spark, folder):
    rows = U.text_lint_rules(doc_lines(spark, folder), lint_fields(), **LINT)
    return rows.select("doc_id", joined("violations").alias("violations"), "valid")


@register
def section_rules(spark, folder):
    rows = U.section_rules(W.docs_md(spark, folder), "md", REQUIRED_PARTS, FORBIDDEN_PARTS)
    return rows.select(
        "doc_id", joined("missing_sections").alias("missing_sections"), joined("forbidden_sections").alias("forbidden_sections"), "valid"
    )


@register
def report_rules(spark, folder):
    rows = U.section_rules(W.report_texts(spark, folder), "report", P.REQUIRED_REPORT_SECTIONS, P.FORBIDDEN_REPORT_PHRASES)
    return rows.select(
        "doc_id", joined("missing_sections").alias("missing_sections"), joined("forbidden_sections").alias("forbidden_sections"), "valid"
    )


@register
def duplicate_fingerprints(spark, folder):
    return U.duplicate_fingerprints(doc_lines(spark, folder), "doc_id", F.col("lines"))


@register
def audit_summary(spark, folder):
    return U.audit_summary(doc_lines(spark, folder), "doc_id", lint_fields(), ("first", "body"), **LINT)


@register
def content_audit(spark, folder):
    """Lint violations of every document together with the size of its group of equal texts."""
    linted = U.text_lint_rules(doc_lines(spark, folder), lint_fields(), **LINT).select(
        "doc_id",
        F.size("violations").alias("rule_failures"),
        F.coalesce(X.native_explanation(F.col("text"), SCRIPT), F.lit(False)).alias("native"),
        U.fingerprint(F.col("lines")).alias("fingerprint"),
    )
    rows = stored(linted, "content_audit")
    groups = U.fingerprint_groups(rows, "doc_id").select("fingerprint", "members")
    copies = F.coalesce("members", F.lit(1))
    return rows.join(groups, "fingerprint", "left").select(
        "doc_id", "rule_failures", "native", copies.alias("copies"), ((F.col("rule_failures") == 0) & (copies == 1)).alias("valid")
    )


@register
def issue_sample(spark, folder):
    linted = U.text_lint_rules(doc_lines(spark, folder), lint_fields(), **LINT)
    rows = stored(linted.select("doc_id", joined("violations").alias("violations"), "valid"), "issues")
    return U.issue_sample(rows.where(~F.col("valid")).drop("valid"), ["doc_id"], 20)


# --- evidence and manifests ---------------------------------------------------------------


@register
def evidence_asof_reuse(spark, folder):
    entries = W.board_entries(spark, folder).where(F.col("capture_date") == F.lit(W.capture(spark, folder)))
    requests = V.evidence_requests(B.distinct_candidates(entries), W.KINDS)
    return V.evidence_asof_reuse(requests, W.evidence(spark, folder), W.capture(spark, folder))


@register
def evidence_refresh(spark, folder):
    """The same requests, those of every fourth name to be fetched anew."""
    capture = W.capture(spark, folder)
    entries = W.board_entries(spark, folder).where(F.col("capture_date") == F.lit(capture))
    requests = V.evidence_requests(B.distinct_candidates(entries), W.KINDS)
    anew = F.regexp_extract("full_name", "([0-9]+)$", 1).cast("bigint") % 4 == 1
    return V.evidence_asof_reuse(requests, W.evidence(spark, folder), capture, refresh=anew)


@register
def newest_per_kind(spark, folder):
    records = W.evidence(spark, folder).withColumn("fetched_on", F.coalesce("fetched_on", "cached_day"))
    return V.newest_per_kind(records, "sha256")


@register
def manifest_hash_verify(spark, folder):
    rows = M.manifest_hash_verify(
        W.document_manifest(spark, folder).select("path", "sha256"), W.document_files(spark, folder)
    )
    return rows.select("path", "sha256", "actual_sha256", "outcome")


@register
def tree_fingerprint(spark, folder):
    return T.tree_fingerprint(M.content_hashes(W.document_files(spark, folder)))


#: Leaves and nodes of these queries are small, so that the trees have several levels at every size of the tables.
SMALL_LEAF, SMALL_FANOUT = 32, 8


@register
def digest_tree(spark, folder):
    """Every node: level, first path, files, digest."""
    tree = T.build_tree(M.content_hashes(W.document_files(spark, folder)), SMALL_LEAF, SMALL_FANOUT)
    return tree.nodes.select("level", "key", "parent", "files", "digest")


@register
def tree_diff(spark, folder):
    """What has changed since the manifest was committed."""
    committed = W.document_manifest(spark, folder).select("path", "sha256")
    trees = [T.build_tree(rows, SMALL_LEAF, SMALL_FANOUT) for rows in (committed, M.content_hashes(W.document_files(spark, folder)))]
    return T.tree_diff(*trees)


@register
def bind_sources(spark, folder):
    manifest = W.document_manifest(spark, folder).select(
        F.col("path").alias("full_name"), F.upper("sha256").alias("source_sha256"), (F.col("bytes") + W.when_mod(F.col("doc_id"), 9, 4, 1, 0)).alias("source_bytes")
    )
    rows = M.bind_sources(manifest, W.document_files(spark, folder))
    return rows.select("full_name", "source_path", "source_artifact", "outcome")


@register
def manifest_source_join(spark, folder):
    manifest = W.document_manifest(spark, folder).select(F.col("path").alias("full_name"), F.col("sha256").alias("source_sha256"))
    rows = M.manifest_source_join(manifest, W.document_files(spark, folder))
    return rows.select("full_name", "source_path", "actual_bytes")


RENDER_VERSION = "r1"


def render(text: Column) -> Column:
    return F.concat(F.lit("<p>"), F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("\n"), F.lit("<br>")), F.lit("</p>"))


def incremental_rows(spark, folder) -> DataFrame:
    docs = W.documents(spark, folder)
    key = F.sha2(F.concat(F.lit(RENDER_VERSION + "\n"), "text"), 256)
    kept = docs.where(F.col("lang") != "en")
    store = kept.select(
        key.alias("content_key"), render(F.col("text")).alias("output"),
        F.sha2(F.concat(render(F.col("text")), W.when_mod(F.length("text"), 5, 0, "x", "")), 256).alias("output_sha256"),
    )
    return M.incremental_by_hash(docs, store, render, RENDER_VERSION)


@register
def incremental_by_hash(spark, folder):
    rows = incremental_rows(spark, folder)
    return rows.select("doc_id", "content_key", "hit", F.sha2("output", 256).alias("output_sha256"))


@register
def incremental_summary(spark, folder):
    return M.incremental_summary(incremental_rows(spark, folder))


@register
def set_equality_audit(spark, folder):
    item = lambda df, c: df.select(F.col(c).cast("string").alias("item"))
    docs, labels = W.documents(spark, folder), read_table(spark, folder, "labels")
    manifest, files = W.document_manifest(spark, folder), W.document_files(spark, folder)
    return M.set_equality_audit(
        {"labels": (item(labels, "doc_id"), item(docs, "doc_id")), "files": (item(files, "path"), item(manifest, "path"))}
    )


@register
def duplicate_bodies(spark, folder):
    return M.duplicate_bodies(W.documents(spark, folder), "text")


@register
def stale_artifacts(spark, folder):
    return M.stale_artifacts(W.document_files(spark, folder), W.document_manifest(spark, folder))


@register
def group_sizes(spark, folder):
    """Documents put into dated runs by their key; some runs have no date for a name."""
    k = F.col("doc_id")
    day = F.date_add(F.lit(date(2024, 1, 1)), (k % 40).cast("int")).cast("string")
    files = W.documents(spark, folder).select(
        F.concat(W.when_mod(k, 12, 5, "draft-", "run-"), day).alias("group"),
        F.octet_length("text").cast("bigint").alias("bytes"),
        F.expr("CAST(octet_length(text) div 3 AS BIGINT)").alias("packed_bytes"),
    )
    return M.group_sizes(files, W.capture(spark, folder))


@register
def manifest_audit(spark, folder):
    """Outcome counts of the hash check, with the set differences and repeated bodies."""
    verified = M.manifest_hash_verify(
        W.document_manifest(spark, folder).select("path", "sha256"), W.document_files(spark, folder)
    )
    outcomes = verified.groupBy(F.col("outcome").alias("finding")).agg(F.count("*").alias("rows"))
    stale = M.stale_artifacts(W.document_manifest(spark, folder), W.document_files(spark, folder))
    bodies = M.duplicate_bodies(W.documents(spark, folder), "text")
    return (
        outcomes.unionByName(stale.agg(F.count("*").alias("rows")).withColumn("finding", F.lit("unlisted")))
        .unionByName(bodies.select(F.lit("repeated_body").alias("finding"), F.col("in_repeated_groups").alias("rows")))
        .select("finding", "rows")
    )


@register
def active_references(spark, folder):
    texts = W.documents(spark, folder).select(F.col("doc_id").alias("text_id"), "text")
    targets = read_table(spark, folder, "benchmark").select(F.col("item_id").alias("target_id"), F.col("text").alias("target"))
    return A.active_references(texts, targets)


# --- scalar functions ------------------------------------------------------------------------


@register
def parse_compact_number(spark, folder):
    k = F.col("c_custkey")
    text = F.concat(
        F.col("c_acctbal").cast("decimal(15,3)").cast("string"),
        F.when(k % 4 == 0, "k stars").when(k % 4 == 1, " M stars").when(k % 4 == 2, ",").otherwise("x"),
    )
    text = F.when(k % 10 == 3, F.lit("none")).otherwise(text)
    return read_table(spark, folder, "customer").select(k.alias("c_custkey"), text.alias("shown"), S.parse_compact_number(text).alias("number"))


@register
def canonical_url(spark, folder):
    name = W.item_name(F.col("c_custkey"))
    return read_table(spark, folder, "customer").select("c_custkey", S.canonical_url(name).alias("url"))


@register
def slug(spark, folder):
    return read_table(spark, folder, "customer").select("c_custkey", S.slug(W.item_name(F.col("c_custkey"))).alias("slug"))


@register
def key_shape(spark, folder):
    k = F.col("c_custkey")
    name = F.when(k % 5 == 0, F.col("c_name")).when(k % 5 == 1, F.concat(F.lit("a/b/"), "c_name")).when(
        k % 5 == 2, F.concat(F.lit("a b/"), "c_name")
    ).otherwise(W.item_name(k))
    return read_table(spark, folder, "customer").select("c_custkey", S.key_shape(name).alias("well_formed"))


@register
def parse_date(spark, folder):
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.when(F.col("o_orderkey") % 9 == 4, F.lit("soon")).otherwise(stamp)
    return read_table(spark, folder, "orders").select("o_orderkey", S.parse_date(text).alias("day"))


@register
def parse_timestamp_utc(spark, folder):
    k = F.col("o_orderkey")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(k % 4 == 0, F.concat(stamp, F.lit("Z"))).when(k % 4 == 1, F.concat(stamp, F.lit("+08:00"))).when(
        k % 4 == 2, F.lit("not a time")
    ).otherwise(stamp)
    return read_table(spark, folder, "orders").select("o_orderkey", F.unix_seconds(S.parse_timestamp_utc(text)).alias("epoch"))


@register
def age_days(spark, folder):
    age = S.age_days(F.lit(W.capture(spark, folder)), F.col("created_at"))
    return W.enrichment(spark, folder).select("full_name", age.alias("age_days"), S.hot_type(age).alias("hot_type"))


NEW_DAYS = 30


@register
def hot_type(spark, folder):
    """With a shorter age limit than the default."""
    age = S.age_days(F.lit(W.capture(spark, folder)), F.col("created_at"))
    return W.enrichment(spark, folder).select("full_name", S.hot_type(age, NEW_DAYS).alias("hot_type"))


@register
def sha256(spark, folder):
    return W.documents(spark, folder).select("doc_id", F.sha2("text", 256).alias("sha256"))


@register
def byte_length(spark, folder):
    return W.documents(spark, folder).select("doc_id", F.octet_length("text").alias("bytes"))


@register
def clamp(spark, folder):
    k = F.col("c_acctbal")
    return read_table(spark, folder, "customer").select("c_custkey", S.clamp(k).alias("clamped"))


@register
def list_bullets(spark, folder):
    return doc_lines(spark, folder).select("doc_id", F.sha2(S.bullets(F.col("lines")), 256).alias("bullets_sha256"))


@register
def label(spark, folder):
    rows = W.enrichment(spark, folder)
    return rows.select(
        "full_name",
        S.label(F.col("language"), P.LABEL_NO_LANGUAGE).alias("language"),
        S.label(F.col("category"), P.LABEL_UNCATEGORIZED).alias("category"),
    )


# --- documents -----------------------------------------------------------------------------


@register
def frontmatter(spark, folder):
    doc = F.col("document")
    rows = W.localized_docs(spark, folder).withColumn("entries", X.frontmatter_entries(doc))
    return rows.select(
        "doc_id",
        *[X.frontmatter_value(F.col("entries"), k).alias(f"meta_{k}") for k in P.FRONTMATTER_KEYS],
        X.frontmatter_complete(F.col("entries")).alias("complete"),
        F.sha2(X.frontmatter_body(doc), 256).alias("body_sha256"),
    )


@register
def script_char_count(spark, folder):
    return W.docs_md(spark, folder).select("doc_id", X.script_chars(F.col("md"), SCRIPT).alias("script_chars"))


@register
def foreign_passage(spark, folder):
    return W.docs_md(spark, folder).select("doc_id", X.has_foreign_passage(F.col("md")).alias("foreign_passage"))


@register
def placeholder_rule(spark, folder):
    return W.docs_md(spark, folder).select("doc_id", X.has_placeholder(F.col("md")).alias("placeholder"))


@register
def fence_balance(spark, folder):
    return W.docs_md(spark, folder).select("doc_id", X.odd_fences(F.col("md")).alias("odd_fences"))


@register
def length_ratio(spark, folder):
    rows = W.localized_docs(spark, folder)
    checks = D.length_rules(F.col("mode"), F.col("body"), F.col("source_bytes"), F.col("translation_bytes"))
    return rows.select("doc_id", "source_bytes", "translation_bytes", joined(S.violations(*checks)).alias("violations"))


def structure_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        joined("blocks", "|").alias("blocks"),
        joined(F.transform("headings", lambda h: h.cast("string"))).alias("headings"),
        "unclosed",
    )


@register
def markdown_structure(spark, folder):
    return structure_columns(D.markdown_structure(W.docs_md(spark, folder), "md"))


@register
def nested_structure(spark, folder):
    """The same documents inside lists, quotes and both: their structure stays, but for indented code."""
    return structure_columns(D.markdown_structure(W.nested_md(spark, folder), "md"))


@register
def nested_diff(spark, folder):
    """Each nested document as a translation of the plain one."""
    plain = W.docs_md(spark, folder).select("doc_id", F.col("md").alias("original"))
    pairs = W.nested_md(spark, folder).withColumnRenamed("md", "body").join(plain, "doc_id").withColumn("mode", F.lit(P.MODE_TRANSLATION))
    rows = D.structure_diff(pairs, source="original", script=SCRIPT)
    return rows.select("doc_id", joined("violations").alias("violations"))


@register
def structure_diff(spark, folder):
    rows = D.structure_diff(W.localized_docs(spark, folder).withColumnRenamed("md", "original"), source="original", script=SCRIPT)
    return rows.select("doc_id", joined("violations").alias("violations"))


@register
def markdown_section(spark, folder):
    usage = X.section(F.col("md"), "Usage")
    return W.docs_md(spark, folder).select(
        "doc_id", F.sha2(usage, 256).alias("usage_sha256"), X.first_paragraph(X.section(F.col("md"), "Summary")).alias("summary")
    )


@register
def media_tags(spark, folder):
    return W.docs_md(spark, folder).select("doc_id", joined(X.media_tags(F.col("md"))).alias("media_tags"))


def link_documents(spark, folder) -> DataFrame:
    k = F.col("doc_id")
    return W.docs_md(spark, folder).select(
        W.item_name(k, "doc").alias("full_name"),
        W.when_mod(k, 2, 0, "main", "feature/x").alias("branch"),
        W.when_mod(k, 4, 1, "docs/guide/README.md", "README.md").alias("doc_path"),
        "md",
    )


@register
def absolutize_links(spark, folder):
    return L.absolutize_links(link_documents(spark, folder), "md")


@register
def absolutize_text(spark, folder):
    rows = L.absolutize_text(link_documents(spark, folder), "md")
    return rows.select("full_name", F.sha2("md", 256).alias("text_sha256"))


@register
def localized_validation(spark, folder):
    rows = D.localized_validation(*W.localized_tables(W.localized_docs(spark, folder)), script=SCRIPT)
    return rows.select("full_name", joined("violations").alias("violations"))


@register
def localized_collection(spark, folder):
    rows = D.localized_collection(*W.localized_set(W.localized_docs(spark, folder)), script=SCRIPT)
    return rows.select("check", "item", joined("violations").alias("violations"))


@register
def rendered_checks(spark, folder):
    docs = W.localized_docs(spark, folder)
    rows = L.rendered_checks(W.rendered_pages(docs), docs.select("full_name", "source_sha256", "translation_sha256", "body"))
    return rows.select("full_name", joined("violations").alias("violations"))


@register
def broken_links(spark, folder):
    pages = W.site_pages(spark, folder)
    return L.broken_links(pages, pages).select("page", "href", "target").distinct()


@register
def link_audit(spark, folder):
    """Per page path: its internal links and how many of them are broken."""
    pages = W.site_pages(spark, folder)
    links = L.page_links(pages).join(L.with_folders(pages).withColumn("known", F.lit(True)), "target", "left")
    counts = links.groupBy("page").agg(F.count("*").alias("links"), F.count_if(F.col("known").isNull()).alias("broken"))
    return counts.select("page", "links", "broken")


@register
def page_outline(spark, folder):
    return L.page_outline(W.site_pages(spark, folder), "page_id", "html")


# --- streams -----------------------------------------------------------------------------------


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@register
def stream_boards(spark, folder):
    from rankloom.streaming.boards import closed_boards, write_daily_totals

    out = run_folder(spark, "boards")
    events = event_stream(spark, folder).select(
        "ts", F.col("event_type").alias("scope"), F.col("user_id").alias("item"), F.round(F.col("value") * 100).cast("bigint").alias("metric")
    )
    write_daily_totals(events, out).awaitTermination()
    boards = closed_boards(spark, out, [W.capture(spark, folder) - timedelta(days=2)], W.TOP)
    return boards.select("capture_date", "scope", "period", "item", "metric", "hits", "rank")


@register
def stream_live_boards(spark, folder):
    """The board of every day, open or closed, as the stream knows it after all events."""
    from rankloom.streaming.live import live_boards, write_live_boards

    out = run_folder(spark, "live")
    events = event_stream(spark, folder).select(
        "ts", F.col("event_type").alias("scope"), F.col("user_id").alias("item"), F.round(F.col("value") * 100).cast("bigint").alias("metric")
    )
    write_live_boards(events, out, W.TOP).awaitTermination()
    return live_boards(spark, out, W.TOP)


@register
def stream_catalog_upsert(spark, folder):
    from rankloom.streaming.catalog import catalog_version, stream_catalog_upsert as run

    out = run_folder(spark, "catalog")
    batch = W.Batch(spark, folder)
    for rows in (batch.prior, batch.current):
        rows.write.mode("append").parquet(f"{out}/evaluations")
        stream = spark.readStream.schema(rows.schema).parquet(f"{out}/evaluations")
        run(stream, out).awaitTermination()
    return catalog_version(spark, f"{out}/catalog")


@register
def stream_dedup_evidence(spark, folder):
    from rankloom.streaming.evidence import write_deduplicated

    out = run_folder(spark, "evidence")
    records = event_stream(spark, folder).select(
        "ts", W.item_name(F.col("user_id")).alias("full_name"), F.col("event_type").alias("kind"), F.sha2("props", 256).alias("sha256")
    )
    write_deduplicated(records, out).awaitTermination()
    rows = spark.read.parquet(f"{out}/evidence")
    return rows.select("bucket_day", "full_name", "kind", "sha256", F.unix_micros("first_seen").alias("first_seen"), "copies")


# --- sources and sinks -----------------------------------------------------------------------


def batch_documents(spark, folder) -> DataFrame:
    """One JSON batch document per capture date, built from the boards and the enrichment."""
    entries = W.board_entries(spark, folder)
    row = F.struct(
        "rank", "full_name", "url", "description", "primary_language", "total_stars", "total_forks", "period_stars", "built_by"
    )
    page = F.struct(
        "scope", "period", "spoken_language", "source_url", "captured_at", "raw_sha256", "status", "entries"
    )
    pages = entries.groupBy(
        "capture_date", "page_no", "scope", "period", "spoken_language", "source_url", "captured_at", "raw_sha256", "status"
    ).agg(F.array_sort(F.collect_list(row)).alias("entries"))
    # boards and their rows are limited in number, so a batch document is, too
    batches = pages.groupBy("capture_date").agg(F.array_sort(F.collect_list(F.struct("page_no", page.alias("page")))).alias("p"))
    enriched = W.enrichment(spark, folder)
    k, note = F.col("item"), F.col("card.one_line")
    card = F.struct(
        *[note.alias(f) for f in P.CARD_SCALAR_FIELDS],
        *[F.array(note).alias(f) for f in ("audience", "limitations")],
        W.when_mod(k, 43, 8, F.array(note), F.array(note, note)).alias("features"),
        F.array(note, note).alias("strengths"),
        F.when(k % 47 == 9, note).alias("ai"),
    )
    repositories = entries.select("capture_date", "full_name").distinct().join(
        enriched.withColumn("card", card).drop("item"), "full_name"
    )
    repo = F.struct(*[c for c in repositories.columns if c != "capture_date"])
    listed = repositories.groupBy("capture_date").agg(F.array_sort(F.collect_list(F.to_json(repo))).alias("r"))
    day = F.col("capture_date").cast("string")
    pool = F.struct(
        F.when(F.dayofmonth("capture_date") == 30, "").otherwise(F.concat(F.lit("boards of "), day)).alias("description"),
        F.lit("full_name").alias("dedupe_key"),
        F.size("r").alias("raw_candidate_count"),
        F.size("r").alias("evaluated_candidate_count"),
    )
    body = F.to_json(
        F.struct(
            F.lit(P.BATCH_VERSION).alias("schema_version"),
            day.alias("capture_date"),
            F.concat(day, F.lit("T10:00:00Z")).alias("captured_at"),
            pool.alias("candidate_pool"),
            F.transform("p", lambda x: x["page"]).alias("pages"),
        ),
        {"ignoreNullFields": "false"},
    )
    with_repos = F.concat(
        F.substring(body, F.lit(1), F.length(body) - 1), F.lit(',"repositories":['), F.array_join("r", ","), F.lit("]}")
    )
    return batches.join(listed, "capture_date").select("capture_date", with_repos.alias("text"))


@register
def read_batch(spark, folder):
    """Write batch documents as JSON files, read them with the batch schema, list their rows."""
    from rankloom.sources.batches import batch_entries, read_batch as read

    out = run_folder(spark, "batch")
    documents = batch_documents(spark, folder).withColumn("doc", F.col("capture_date").cast("string"))
    documents.select("text", "doc").write.partitionBy("doc").text(out)
    rows = batch_entries(read(spark, out))
    return rows.select("capture_date", "scope", "period", "rank", "full_name", "period_stars", "status")


@register
def schema_conformance(spark, folder):
    from rankloom.sources.batches import schema_conformance as check

    batches = batch_documents(spark, folder).withColumn("doc", F.col("capture_date").cast("string"))
    rows = check(batches, scopes=W.SCOPES[:-1] + ("rust",))
    return rows.select("doc", "object", "position", joined("violations").alias("violations"))


@register
def write_snapshots(spark, folder):
    """Write both captures, then write the newer one again: only its date is replaced."""
    from rankloom.sources.batches import write_snapshots as write

    out = run_folder(spark, "snapshots")
    batch = W.Batch(spark, folder)
    rows = batch.evaluations.select("capture_date", "full_name", "status", "final_score")
    path = write(out, evaluations=rows)["evaluations"]
    write(out, evaluations=rows.where(F.col("capture_date") == F.lit(batch.day)))
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
