"""From raw documents to packed training sequences: five stages, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.common import read
from rankloom.llm.decontamination import decontaminate
from rankloom.llm.near_duplicates import keep_one
from rankloom.llm.packing import pack
from rankloom.llm.quality_rules import fit, keep_good
from rankloom.llm.suffix_dedup import without_repeats
from rankloom.session import run_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line labelling keep."""
    return keep_good(docs, fit(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of repeated long substrings."""
    return without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences: one row per piece, with its token ids."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: No SQL: training and tokenizing are among the stages. Tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; the stages' results lie in the shared folder, in ``rankloom-*``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = run_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
