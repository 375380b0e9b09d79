"""The long-lived catalog: keyed upsert, orders, search, facets and reports."""

from __future__ import annotations

import unicodedata
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom import params as P
from rankloom.functions.scalars import label, slug
from rankloom.operators.positions import with_position

CATALOG_FIELDS = (
    "full_name", "url", "category", "language", "hot_type", "trend_score", "quality_score", "value_score",
    "value_level", "primary_period", "license_name", "license_scope", "final_score", "grade", "one_line", "card",
)
CATALOG_SCHEMA = (
    "full_name STRING, url STRING, category STRING, language STRING, hot_type STRING, trend_score DOUBLE,"
    " quality_score INT, value_score INT, value_level STRING, primary_period STRING, license_name STRING,"
    " license_scope STRING, final_score DOUBLE, grade STRING, one_line STRING, card STRING,"
    " first_accepted DATE, last_evaluated DATE"
)


def accepted_rows(evaluations: DataFrame) -> DataFrame:
    """Accepted evaluations in catalog form."""
    return evaluations.where(F.col("status") == "accepted").select(
        "full_name",
        "url",
        "category",
        "language",
        "hot_type",
        "trend_score",
        F.col("quality.total").alias("quality_score"),
        F.col("value.total").alias("value_score"),
        F.col("value.level").alias("value_level"),
        "primary_period",
        F.col("license.name").alias("license_name"),
        F.col("license.scope_zh").alias("license_scope"),
        "final_score",
        "grade",
        F.col("card.one_line").alias("one_line"),
        F.concat(F.lit("repos/"), slug(F.col("full_name")), F.lit(".md")).alias("card"),
        F.col("capture_date").alias("first_accepted"),
        F.col("capture_date").alias("last_evaluated"),
    )


def catalog_upsert(catalog: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Catalog after a batch. Accepted rows replace all listed fields (a null included) and
    keep the first acceptance date; rejected and absent rows change nothing.

    It is a full outer merge written as one aggregate by key: each key has at most one
    catalog row and one row per batch date, so no key is hot.
    """
    held = catalog.withColumn("_incoming", F.lit(0))
    fresh = accepted_rows(evaluations).withColumn("_incoming", F.lit(1))
    rows = held.unionByName(fresh)
    newest = F.max_by(
        F.struct(*CATALOG_FIELDS[1:], "last_evaluated"), F.struct("_incoming", "last_evaluated")
    ).alias("row")
    kept = F.min(F.when(F.col("_incoming") == 0, F.col("first_accepted")))
    merged = rows.groupBy("full_name").agg(
        newest, F.coalesce(kept, F.min("first_accepted")).alias("first_accepted")
    )
    fields = [F.col(f"row.{c}") for c in CATALOG_FIELDS[1:]]
    return merged.select("full_name", *fields, "first_accepted", "row.last_evaluated")


def first_accepted(evaluations: DataFrame) -> DataFrame:
    return (
        evaluations.where(F.col("status") == "accepted")
        .groupBy("full_name")
        .agg(F.min("capture_date").alias("first_accepted"))
    )


def newly_accepted(evaluations: DataFrame, catalog: DataFrame, capture: date) -> DataFrame:
    """Accepted evaluations whose key entered the catalog on this very date."""
    entered = catalog.where(F.col("first_accepted") == F.lit(capture)).select("full_name")
    return evaluations.where(
        (F.col("status") == "accepted") & (F.col("capture_date") == F.lit(capture))
    ).join(entered, "full_name", "left_semi")


def catalog_order(catalog: DataFrame) -> DataFrame:
    """Catalog by score, then name, with explicit positions."""
    return with_position(catalog, [F.desc("final_score"), F.lower("full_name"), F.col("full_name")])


def accepted_order(evaluations: DataFrame) -> DataFrame:
    accepted = evaluations.where(F.col("status") == "accepted").select("full_name", "final_score", "grade")
    return with_position(accepted, [F.desc("final_score"), F.col("full_name")])


def per_period_index(catalog: DataFrame) -> DataFrame:
    """Catalog order within each primary period; a missing period counts as weekly."""
    rows = catalog.withColumn("period", F.coalesce("primary_period", F.lit(P.DEFAULT_PERIOD)))
    return with_position(
        rows, [F.desc("final_score"), F.lower("full_name"), F.col("full_name")], by=("period",)
    )


def search_text(*columns: Column) -> Column:
    return F.lower(F.concat_ws(" ", *columns))


@F.pandas_udf(T.StringType())
def _normalized(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def compatible(text: Column) -> Column:
    """Unicode compatibility form. ASCII text has it already and reaches Python as null."""
    foreign = F.when(text.rlike(r"[^\x00-\x7F]"), text)
    return F.coalesce(_normalized(foreign), text)


def catalog_search(
    catalog: DataFrame, query: str = "", category: str | None = None, language: str | None = None, search: str = "search"
) -> DataFrame:
    """All whitespace-separated tokens occur in the search text, and the given facets match. Both sides are
    compared in compatible form (full-width letters are letters) and lower case."""
    kept = catalog
    for token in unicodedata.normalize("NFKC", query).lower().split():
        kept = kept.where(F.contains(F.lower(compatible(F.col(search))), F.lit(token)))
    if category:
        kept = kept.where(F.col("category") == category)
    if language:
        kept = kept.where(F.col("language") == language)
    return kept


def facets(catalog: DataFrame) -> DataFrame:
    """Distinct categories and languages with their number of entries, sorted."""
    pairs = F.array(
        F.struct(F.lit("category").alias("facet"), label(F.col("category"), P.LABEL_UNCATEGORIZED).alias("value")),
        F.struct(F.lit("language").alias("facet"), label(F.col("language"), P.LABEL_NO_LANGUAGE).alias("value")),
    )
    counted = catalog.select(F.explode(pairs).alias("f")).groupBy("f.facet", "f.value").agg(F.count("*").alias("entries"))
    return counted.orderBy("facet", "value")


def latest_attribute(batches: DataFrame, column: str = "language", default: str = P.LABEL_NO_LANGUAGE) -> DataFrame:
    """The attribute as of the newest batch of each key; a missing one becomes the label."""
    newest = F.max_by(F.struct(label(F.col(column), default).alias("v")), F.struct("capture_date"))
    return batches.groupBy("full_name").agg(newest["v"].alias(column), F.max("capture_date").alias("capture_date"))


def detail_join(catalog: DataFrame, summaries: DataFrame, languages: DataFrame) -> DataFrame:
    """Catalog with the card's summary and the latest language, labels where both are missing."""
    s = summaries.select("full_name", F.col("one_line").alias("card_line"))
    lang = languages.select("full_name", F.col("language").alias("latest_language"))
    joined = catalog.join(s, "full_name", "left").join(lang, "full_name", "left")
    category = label(F.col("category"), P.LABEL_UNCATEGORIZED)
    language = F.coalesce(F.nullif("latest_language", F.lit("")), label(F.col("language"), P.LABEL_NO_LANGUAGE))
    summary = F.coalesce(F.nullif("card_line", F.lit("")), F.col("one_line"), F.lit(""))
    return joined.select(
        "full_name",
        category.alias("category"),
        language.alias("language"),
        summary.alias("summary"),
        F.concat_ws(" ", "full_name", summary, category, language).alias("search"),
        "last_evaluated",
    )


def normalized_projection(evaluations: DataFrame) -> DataFrame:
    return evaluations.select(
        "capture_date",
        "full_name",
        "grade",
        "trend_score",
        F.col("quality.total").alias("quality_score"),
        F.col("value.total").alias("value_score"),
        "final_score",
    )


def history_desc(dated: DataFrame) -> DataFrame:
    """Distinct dates, newest first, each with a flag for the latest."""
    latest = dated.agg(F.max("capture_date")).scalar()
    dates = dated.select("capture_date").distinct()
    return dates.withColumn("latest", F.col("capture_date") == latest).orderBy(F.desc("capture_date"))
