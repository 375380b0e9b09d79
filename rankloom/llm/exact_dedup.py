"""Exact duplicates by a 128-bit content hash, with the bytes compared inside groups.

One scan turns each text into a narrow row: id, hash, a row number. Groups are counted on those rows alone,
with map-side combine, so a text that a third of the rows share sends one row per task. A second scan takes
the texts whose hash occurs more than once and groups them by (hash, bytes): equal texts collapse in the task
that reads them, and a hash with two different texts is a collision. Rows of such hashes are grouped again by
their bytes; all others take what their hash's group chose. Column functions only.

Defined results: a null text counts as empty; a null id is preferred to no other (it stays only if the group
has no id); of rows that agree in id and text one stays; an empty table gives an empty result; further columns
are ignored by ``duplicate_report`` and kept by ``drop_copies``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.session import stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Up to so many repeated hashes are broadcast as filter of the second scan: 8 bytes each, some 32 MB as a
#: table of longs. Beyond that all texts are compared, each collapsed in its task first.
FILTER_KEYS = 1 << 20


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z alone. ``lower`` does the same for a text without other characters, and faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _chosen(rows: DataFrame, by: list[str], keep: str, name: str) -> DataFrame:
    """Of each group of two rows or more: its size and the row that stays."""
    row = lambda last: F.struct(last.alias("last"), F.col("id"), F.col("row"))
    best = F.max(row(F.col("id").isNotNull())) if keep == "largest" else F.min(row(F.col("id").isNull()))
    groups = rows.groupBy(*by).agg(F.count("*").alias("size"), best.alias("best"))
    return stored(groups.where("size > 1").select(*by, "size", F.col("best.id").alias("best_id"), F.col("best.row").alias("best_row")), name)


def _elected(rows: DataFrame, groups: DataFrame, by: list[str], carry: list[str]) -> DataFrame:
    """Each row with its group's choice; a row alone stays. The join's large side may be split anywhere."""
    single = F.col("size").isNull()
    return rows.join(groups, by, "left").select(
        "id",
        *carry,
        "sha",
        F.when(single, F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("best_row") == F.col("row"))).alias("kept"),
        "key",
    )


def _collisions(texts: DataFrame, groups: DataFrame, limit: int) -> DataFrame:
    """Hashes that two different texts share."""
    if groups.count() <= limit:
        probe = groups.select(F.xxhash64("key").alias("probe"))
        texts = texts.withColumn("probe", F.xxhash64("key")).join(F.broadcast(probe), "probe", "left_semi").drop("probe")
    bodies = texts.groupBy("key", "body").agg(F.count("*").alias("rows"))
    return bodies.groupBy("key").agg(F.count("*").alias("bodies")).where("bodies > 1").select("key")


def duplicate_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "smallest",
    fold: bool = True,
    carry: tuple[str, ...] = (),
    digest: Callable[[Column], Column] = content_hash,
    filter_keys: int = FILTER_KEYS,
) -> DataFrame:
    """Per row: ``id``, the columns to ``carry``, ``sha`` (SHA-256 of the compared text, as bytes), ``keep_id``, ``group_size``, ``kept``, ``key``.

    ``fold``: texts that differ in the case of A-Z alone are equal. ``keep``: the id that stays, "smallest" or "largest"."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    body = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), *carry, (fold_ascii(body) if fold else body).alias("body"))
    texts = texts.withColumn("key", digest(F.col("body")))
    sha, row = F.unhex(F.sha2("body", 256)).alias("sha"), F.monotonically_increasing_id().alias("row")
    narrow = texts.select("id", *carry, "key", sha, row)
    rows = stored(narrow, "exact-rows")
    groups = _chosen(rows, ["key"], keep, "exact-groups")
    collided = stored(_collisions(texts.select("key", "body"), groups, filter_keys), "exact-collisions")
    if collided.isEmpty():
        return _elected(rows, groups, ["key"], [*carry])
    apart = stored(texts.join(collided, "key", "left_semi").select("id", *carry, "key", "body", sha, row), "exact-apart")
    by = ["key", "body"]
    whole = _elected(rows.join(collided, "key", "left_anti"), groups, ["key"], [*carry])
    return whole.unionByName(_elected(apart, _chosen(apart, by, keep, "exact-apart-groups"), by, [*carry]))


def duplicate_report(docs: DataFrame, keep: str = "smallest", **options) -> DataFrame:
    """One row per document: which of its equals stays, how many they are, and the digest of the compared text."""
    return duplicate_groups(docs, keep=keep, **options).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fold: bool = True, **options) -> DataFrame:
    """``docs`` with all columns, one row of each group of equal texts."""
    kept = duplicate_groups(docs, id_column, text_column, fold=fold, **options).where("kept").select("id", "sha")
    body = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    record = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
        F.col(f"`{id_column}`").alias("id"),
        F.unhex(F.sha2(fold_ascii(body) if fold else body, 256)).alias("sha"),
    )
    # Rows that agree in id and text meet here: one of them stays.
    same = record.alias("r").join(kept.alias("k"), F.col("r.id").eqNullSafe(F.col("k.id")) & (F.col("r.sha") == F.col("k.sha")), "left_semi")
    times = record.groupBy("id", "sha").agg(F.count("*").alias("times")).where("times > 1")
    joined = same.alias("r").join(times.alias("t"), F.col("r.id").eqNullSafe(F.col("t.id")) & (F.col("r.sha") == F.col("t.sha")), "left")
    parted = joined.select("r.record", "r.id", "r.sha", "t.times")
    once = parted.where("times IS NULL").select("record")
    first = parted.where("times > 1").dropDuplicates(["id", "sha"]).select("record")
    return once.unionByName(first).select(*[F.col(f"record.`{c}`").alias(c) for c in docs.columns])
