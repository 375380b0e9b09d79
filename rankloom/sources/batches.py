"""Batch documents in, dated tables out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions.scalars import key_shape, parse_timestamp_utc, violations
from rankloom.session import rebalanced

ENTRY = (
    "STRUCT<rank: INT, full_name: STRING, url: STRING, description: STRING, primary_language: STRING,"
    " total_stars: BIGINT, total_forks: BIGINT, period_stars: BIGINT, built_by: ARRAY<STRING>>"
)
PAGE = (
    "STRUCT<scope: STRING, period: STRING, spoken_language: STRING, source_url: STRING, captured_at: STRING,"
    f" raw_sha256: STRING, status: STRING, entries: ARRAY<{ENTRY}>>"
)
SCORED = "scores: MAP<STRING, INT>, total: INT, rationale: STRING, evidence_urls: ARRAY<STRING>"
REPOSITORY = (
    "STRUCT<full_name: STRING, url: STRING, description: STRING, category: STRING, created_at: STRING,"
    " pushed_at: STRING, is_fork: BOOLEAN, is_mirror: BOOLEAN, archived: BOOLEAN, language: STRING,"
    " hard_filter: MAP<STRING, BOOLEAN>,"
    " license: STRUCT<name: STRING, scope_zh: STRING, evidence_urls: ARRAY<STRING>>,"
    f" quality: STRUCT<{SCORED}>, value: STRUCT<{SCORED}, level: STRING>,"
    " card: STRUCT<one_line: STRING, what: STRING, audience: ARRAY<STRING>, usage: STRING,"
    " features: ARRAY<STRING>, why: STRING, strengths: ARRAY<STRING>, limitations: ARRAY<STRING>, value: STRING>,"
    " evidence_urls: ARRAY<STRING>>"
)
BATCH_SCHEMA = (
    "schema_version INT, capture_date STRING, captured_at STRING,"
    " candidate_pool STRUCT<description: STRING, dedupe_key: STRING,"
    " raw_candidate_count: BIGINT, evaluated_candidate_count: BIGINT>,"
    f" pages ARRAY<{PAGE}>, repositories ARRAY<{REPOSITORY}>, _corrupt STRING"
)
# Field names each object may have; anything else is an extra field.
ALLOWED_FIELDS = {
    "batch": ("schema_version", "capture_date", "captured_at", "candidate_pool", "pages", "repositories"),
    "page": ("scope", "period", "spoken_language", "source_url", "captured_at", "raw_sha256", "status", "entries"),
    "entry": (
        "rank", "full_name", "url", "description", "primary_language",
        "total_stars", "total_forks", "period_stars", "built_by",
    ),
    "repository": (
        "full_name", "url", "description", "category", "created_at", "pushed_at", "is_fork", "is_mirror",
        "archived", "language", "hard_filter", "license", "quality", "value", "card", "evidence_urls",
    ),
    "license": ("name", "scope_zh", "evidence_urls"),
    "card": P.CARD_SCALAR_FIELDS + P.CARD_LIST_FIELDS,
}


def read_batch(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Nested batch documents, one per file or one per line; a document that is not valid JSON
    keeps its text in ``_corrupt``."""
    reader = spark.read.schema(BATCH_SCHEMA).option("multiLine", str(one_per_file).lower())
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def batch_entries(batch: DataFrame) -> DataFrame:
    """One row per ranked row of a batch; a page without rows stays as one row with a null rank."""
    pages = batch.select(
        F.to_date("capture_date").alias("capture_date"), F.posexplode("pages").alias("page_no", "page")
    )
    header = ("scope", "period", "spoken_language", "source_url", "captured_at", "raw_sha256", "status")
    return pages.select(
        "capture_date", "page_no", *[f"page.{c}" for c in header], F.explode_outer("page.entries").alias("entry")
    ).select("capture_date", "page_no", *header, "entry.*")


def batch_repositories(batch: DataFrame) -> DataFrame:
    return batch.select(
        F.to_date("capture_date").alias("capture_date"), F.explode("repositories").alias("repository")
    ).select("capture_date", "repository.*")


def _extra_fields(raw: Column, allowed: tuple[str, ...]) -> Column:
    names = F.json_object_keys(raw)
    return F.coalesce(F.size(F.array_except(names, F.array(*[F.lit(a) for a in allowed]))) > 0, F.lit(False))


def _missing_fields(raw: Column, required: tuple[str, ...]) -> Column:
    names = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    return F.size(F.array_except(F.array(*[F.lit(r) for r in required]), names)) > 0


def _kind(raw: Column, path: str) -> Column:
    """JSON kind of a field, from its schema: BIGINT, STRING, BOOLEAN, ARRAY<…>, STRUCT<…>, …"""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(raw), path, "variant"))


def _not_integer(raw: Column, field: str) -> Column:
    return F.coalesce(_kind(raw, f"$.{field}") != "BIGINT", F.lit(True))


def schema_conformance(
    raw: DataFrame, text: str = "text", key: str = "doc", scopes: tuple[str, ...] = P.SCOPES
) -> DataFrame:
    """Structural rules on raw JSON text, one row per object of the batch with its violations.

    Types are read from the JSON itself, so ``true`` is never taken for a number.
    """
    doc = F.col(text)
    pages = F.from_json(F.get_json_object(doc, "$.pages"), "array<string>")
    repos = F.from_json(F.get_json_object(doc, "$.repositories"), "array<string>")
    page_count = F.coalesce(F.size(pages), F.lit(0))
    batch = violations(
        (F.try_parse_json(doc).isNull(), "not_json"),
        (_missing_fields(doc, ALLOWED_FIELDS["batch"]), "missing_field"),
        (_extra_fields(doc, ALLOWED_FIELDS["batch"]), "extra_field"),
        (_not_integer(doc, "schema_version"), "schema_version_type"),
        (F.get_json_object(doc, "$.schema_version") != str(P.BATCH_VERSION), "schema_version"),
        (F.try_to_date(F.get_json_object(doc, "$.capture_date"), "yyyy-MM-dd").isNull(), "capture_date"),
        (parse_timestamp_utc(F.get_json_object(doc, "$.captured_at")).isNull(), "captured_at"),
        (F.get_json_object(doc, "$.candidate_pool.dedupe_key") != "full_name", "dedupe_key"),
        (F.coalesce(F.length(F.get_json_object(doc, "$.candidate_pool.description")), F.lit(0)) < 1, "description"),
        (page_count != len(scopes) * len(P.PERIODS), "page_count"),
        (F.coalesce(F.size(repos), F.lit(0)) < 1, "repository_count"),
    )
    top = raw.select(key, F.lit("batch").alias("object"), F.lit(0).alias("position"), batch.alias("violations"))

    page_rows = raw.select(key, F.posexplode(pages).alias("position", "raw"))
    p = F.col("raw")
    page_rules = violations(
        (_missing_fields(p, ALLOWED_FIELDS["page"]), "missing_field"),
        (_extra_fields(p, ALLOWED_FIELDS["page"]), "extra_field"),
        (~F.get_json_object(p, "$.scope").isin(*scopes), "scope"),
        (~F.get_json_object(p, "$.period").isin(*P.PERIODS), "period"),
        (F.get_json_object(p, "$.spoken_language") != "any", "spoken_language"),
        (parse_timestamp_utc(F.get_json_object(p, "$.captured_at")).isNull(), "captured_at"),
        (~F.get_json_object(p, "$.raw_sha256").rlike("^[A-Fa-f0-9]{64}$"), "raw_sha256"),
        (~F.get_json_object(p, "$.status").isin("success", "failed"), "status"),
        (~F.startswith(_kind(p, "$.entries"), F.lit("ARRAY")), "entries_type"),
    )
    entry_rows = page_rows.select(
        key,
        F.col("position").alias("page"),
        F.posexplode(F.from_json(F.get_json_object(p, "$.entries"), "array<string>")).alias("position", "raw"),
    )
    entry_rules = violations(
        (_missing_fields(p, ALLOWED_FIELDS["entry"]), "missing_field"),
        (_extra_fields(p, ALLOWED_FIELDS["entry"]), "extra_field"),
        (_not_integer(p, "rank") | (F.get_json_object(p, "$.rank").cast("bigint") < 1), "rank"),
        (~key_shape(F.get_json_object(p, "$.full_name")), "full_name"),
        (~_kind(p, "$.description").isin("STRING"), "description_type"),
        (_not_integer(p, "total_stars") | (F.get_json_object(p, "$.total_stars").cast("bigint") < 0), "total_stars"),
        (_not_integer(p, "total_forks") | (F.get_json_object(p, "$.total_forks").cast("bigint") < 0), "total_forks"),
        (
            ~_kind(p, "$.period_stars").isin("BIGINT", "VOID")
            | (F.get_json_object(p, "$.period_stars").cast("bigint") < 0),
            "period_stars",
        ),
        (~F.startswith(_kind(p, "$.built_by"), F.lit("ARRAY")), "built_by_type"),
    )
    repo_rows = raw.select(key, F.posexplode(repos).alias("position", "raw"))
    card = F.get_json_object(p, "$.card")
    repo_rules = violations(
        (_missing_fields(p, ALLOWED_FIELDS["repository"]), "missing_field"),
        (_extra_fields(p, ALLOWED_FIELDS["repository"]), "extra_field"),
        (_missing_fields(F.get_json_object(p, "$.license"), ALLOWED_FIELDS["license"]), "license_missing_field"),
        (_extra_fields(F.get_json_object(p, "$.license"), ALLOWED_FIELDS["license"]), "license_extra_field"),
        (_missing_fields(card, ALLOWED_FIELDS["card"]), "card_missing_field"),
        (_extra_fields(card, ALLOWED_FIELDS["card"]), "card_extra_field"),
        *[
            (F.coalesce(_kind(p, f"$.{flag}") != "BOOLEAN", F.lit(True)), f"{flag}_type")
            for flag in P.STATE_FLAGS
        ],
        *[
            (
                F.coalesce(F.size(F.from_json(F.get_json_object(card, f"$.{f}"), "array<string>")), F.lit(0))
                < P.MIN_ITEMS.get(f, 1),
                f"card_{f}_items",
            )
            for f in P.CARD_LIST_FIELDS
        ],
        *[
            (F.coalesce(F.length(F.get_json_object(card, f"$.{f}")), F.lit(0)) < 1, f"card_{f}_empty")
            for f in P.CARD_SCALAR_FIELDS
        ],
    )
    parts = [
        top,
        page_rows.select(key, F.lit("page").alias("object"), "position", page_rules.alias("violations")),
        entry_rows.select(
            key,
            F.lit("entry").alias("object"),
            (F.shiftleft(F.col("page").cast("bigint"), 32) + F.col("position")).alias("position"),
            entry_rules.alias("violations"),
        ),
        repo_rows.select(key, F.lit("repository").alias("object"), "position", repo_rules.alias("violations")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_dated(df: DataFrame, path: str, date_column: str = "capture_date", *more: str) -> None:
    """Write a dated table; only the dates in ``df`` (and parts of them, by ``more`` columns) are replaced, others stay."""
    (
        rebalanced(df, date_column, *more)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column, *more)
        .parquet(path)
    )


def write_snapshots(folder: str, **tables: DataFrame) -> dict[str, str]:
    """Write pages, snapshots, evaluations, editions, rejections, … each as a dated table."""
    paths = {name: f"{folder}/{name}" for name in tables}
    for name, df in tables.items():
        write_dated(df, paths[name])
    return paths

