"""Benchmark decontamination by spaced seeds, with DataFrame functions alone.

Fixed masks select token positions of a window and ignore the others, so a window still matches when the
ignored tokens were substituted. Each window of a document and of a benchmark item gives one hash per
mask; equal hashes are hits. The hits of one document and item on one diagonal (document place minus item
place) are verified once: tokens of both are compared along the diagonal, an equal pair counts 1 and an
unequal one -1, and the best-scoring stretch must reach ``MIN_SCORE``.

The masks find every stretch with at least ``max span`` tokens in which every fifth (or rarer) token, every
fourth, or every third differs. Items with fewer tokens than the shortest mask cannot reach the score
and are no evidence.

Tokens are runs of letters and digits, lower case. Null or empty texts have none. Rows of one doc_id are
one document with several texts. Null ids are ordinary values. Other columns are not read.

The seeds of the items are counted, and broadcast only when they are few (``BROADCAST_BYTES``, at ``SEED_BYTES`` each); beyond
it the same join shuffles, and adaptive execution splits hot seeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import total_bytes

MASKS = ("111101111", "11101110111", "11011011011")
MIN_SCORE = 10
BROADCAST_BYTES = 64 << 20
SEED_BYTES = 128


def tokens(text: str) -> Column:
    return F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")


def seeds(rows: DataFrame, *ids: str, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """One row per window and mask: ids, ``at`` (place of the window's first token), ``seed``.

    The token array is zipped with its own shifts, so a window's tokens are columns of one row."""
    span = max(map(len, masks))
    size = F.size("tokens")
    shifts = [F.slice("tokens", F.lit(k + 1), size).alias(f"t{k}") for k in range(span)]
    windows = rows.select(*ids, F.posexplode_outer(F.arrays_zip(*[s for s in shifts])).alias("at", "w"))
    hashes = []
    for number, mask in enumerate(masks):
        used = [F.col(f"w.t{k}") for k, bit in enumerate(mask) if bit == "1"]
        hashes.append(F.when(used[-1].isNotNull(), F.xxhash64(F.lit(number), *used)))
    return windows.select(*ids, "at", F.stack(F.lit(len(masks)), *hashes).alias("seed")).where("seed is not null")


def overlaps(docs: DataFrame, benchmark: DataFrame, min_score: int = MIN_SCORE, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """One row per document and item with a verified overlap: doc_id, item_id, score, matched, item_tokens,
    doc_start (place of the item's first token in the document; negative if it began before the text)."""
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    texts = named.select("doc_id", "text_key", tokens("text").alias("tokens"))
    items = benchmark.select("item_id", "text").distinct()
    items = items.select("item_id", F.xxhash64("text").alias("item_key"), F.filter(tokens("text"), lambda t: t != "").alias("tokens"))
    windows = items.select(F.sum(F.size("tokens").cast("long")).alias("n")).first()["n"] or 0
    small = windows * len(masks) * SEED_BYTES <= BROADCAST_BYTES and total_bytes(benchmark) <= BROADCAST_BYTES
    hint = F.broadcast if small else (lambda df: df)

    keys = seeds(items, "item_id", "item_key", masks=masks).withColumnRenamed("at", "item_at")
    hits = seeds(texts, "doc_id", "text_key", masks=masks).join(hint(keys), "seed")
    lines = hits.select("doc_id", "text_key", "item_id", "item_key", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()

    same = lines["doc_id"].eqNullSafe(named["doc_id"]) & (lines["text_key"] == named["text_key"])
    found = lines.join(named, same).select(lines["doc_id"], lines["item_id"], lines["item_key"], "diagonal", tokens("text").alias("tokens"))
    wording = items.withColumnRenamed("tokens", "wording")
    both = found.join(hint(wording), found["item_id"].eqNullSafe(wording["item_id"]) & (found["item_key"] == wording["item_key"]))
    begin, skipped = F.greatest("diagonal", F.lit(0)), F.greatest(-F.col("diagonal"), F.lit(0))
    length = F.least(F.size("tokens") - begin, F.size("wording") - skipped)
    equal = F.zip_with(F.slice("tokens", begin + 1, length), F.slice("wording", skipped + 1, length), lambda a, b: F.when(a == b, 1).otherwise(-1))
    state = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))
    best = F.aggregate(
        "equal",
        state,
        lambda s, e: F.struct((F.greatest(s["run"], F.lit(0)) + e).alias("run"), F.greatest(s["best"], F.greatest(s["run"], F.lit(0)) + e).alias("best")),
        lambda s: s["best"],
    )
    compared = both.select(found["doc_id"], found["item_id"], "diagonal", F.size("wording").alias("item_tokens"), equal.alias("equal"))
    scored = compared.select(
        "doc_id", "item_id", "diagonal", "item_tokens", best.alias("score"), F.aggregate("equal", F.lit(0), lambda n, e: n + F.greatest(e, F.lit(0))).alias("matched")
    )
    top = scored.where(F.col("score") >= min_score).groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "matched", "item_tokens", (-F.col("diagonal")).alias("back"))).alias("top"))
    return top.select(
        "doc_id",
        "item_id",
        F.col("top.score").cast("long").alias("score"),
        F.col("top.matched").cast("long").alias("matched"),
        F.col("top.item_tokens").cast("long").alias("item_tokens"),
        (-F.col("top.back")).cast("long").alias("doc_start"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose doc_id has no overlap with the benchmark, all columns."""
    bad = overlaps(docs, benchmark, **options).select(F.col("doc_id").alias("_contaminated")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_contaminated"]), "left_anti")
