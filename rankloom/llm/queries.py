"""One query per operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.common import read
from rankloom.llm.oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

__all__ = ["ORACLE", "QUERIES"]


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op4_sharding(spark, folder):
    from rankloom.llm.sharding import shard_digest

    return shard_digest(read(spark, folder, "documents"))


@register
def op10_packing(spark, folder):
    from rankloom.llm.packing import pack

    return pack(read(spark, folder, "documents"), with_ids=False)


@register
def op9_quality_rules(spark, folder):
    from rankloom.llm.quality_rules import fit, quality_report

    docs = read(spark, folder, "documents")
    return quality_report(docs, fit(docs, read(spark, folder, "labels")))


@register
def op1_license_scan(spark, folder):
    from rankloom.llm.license_scan import license_scan

    return license_scan(read(spark, folder, "documents"))


@register
def op8_html_extraction(spark, folder):
    from rankloom.llm.html_text import main_text

    return main_text(read(spark, folder, "pages"))


@register
def op5_decontamination(spark, folder):
    from rankloom.llm.decontamination import overlaps

    return overlaps(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@register
def op7_near_duplicates(spark, folder):
    """Three-word shingles and 85 percent, as the query asks."""
    from rankloom.llm.near_duplicates import near_duplicates

    return near_duplicates(read(spark, folder, "documents"), width=3, percent=85).drop("text_key")


@register
def op2_suffix_dedup(spark, folder):
    from rankloom.llm.suffix_dedup import suffix_dedup

    return suffix_dedup(read(spark, folder, "documents"), with_text=False)


@register
def op6_lm_scores(spark, folder):
    from rankloom.llm.language_model import lm_scores

    return lm_scores(read(spark, folder, "documents"))


@register
def op3_quality_classifier(spark, folder):
    from rankloom.llm.quality_classifier import fit, quality_scores

    docs = read(spark, folder, "documents")
    return quality_scores(docs, fit(docs))


@register
def op12_exact_dedup(spark, folder):
    """Of equal texts the row with the largest id stays, as the query asks."""
    from rankloom.llm.exact_dedup import duplicate_report

    return duplicate_report(read(spark, folder, "documents"), keep="largest")


@register
def op11_filter_audit(spark, folder):
    from rankloom.llm.filter_audit import filter_audit

    return filter_audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


@register
def op13_source_divergence(spark, folder):
    from rankloom.llm.divergence import divergence

    return divergence(read(spark, folder, "documents"))
