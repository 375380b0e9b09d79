"""Containment search: which stored texts mention which targets.

Containment has no join key of its own, and comparing all pairs does not scale. Each target
is given a key: if a text contains the target, it also contains the target's inner tokens as
whole tokens. The rarest of them is the target's anchor. Texts and targets are then joined on
the anchor, and the candidate pairs are verified with ``contains``.

A target of one or two tokens has no inner token. Its longest token must then lie inside some
token of the text; the tokens it lies in are looked up in the vocabulary by short grams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.rows import unnest
from rankloom.session import stored

TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"
GRAM = 3
BROADCAST_LIMIT = 64 * 1024 * 1024


def normalized(text: Column) -> Column:
    return F.lower(F.replace(text, F.lit("\\"), F.lit("/")))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _grams(token: Column, size: Column) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(token) - size + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(token, i, size)))


def _vocabulary_matches(short: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(target_id, token) for every vocabulary token that contains the target's piece."""
    pieces = short.select("target_id", F.array_max(F.transform("parts", _sized))["token"].alias("piece"))
    keyed = pieces.withColumn("size", F.least(F.lit(GRAM), F.length("piece"))).withColumn(
        "gram", F.substr("piece", F.lit(1), F.col("size"))
    )
    sizes = F.explode(F.sequence(F.lit(1), F.lit(GRAM)))
    grams = (
        vocabulary.select("token", sizes.alias("size"))
        .where(F.length("token") >= F.col("size"))
        .select("token", F.explode(_grams(F.col("token"), F.col("size"))).alias("gram"))
    )
    return keyed.join(grams, "gram").where(F.contains("token", F.col("piece"))).select("target_id", "token").distinct()


def _sized(token: Column) -> Column:
    return F.struct(F.length(token).alias("length"), token.alias("token"))


def active_references(texts: DataFrame, targets: DataFrame, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """(text_id, target_id) for each text that contains the target, ignoring case and slash style.

    ``texts`` is (text_id, text), ``targets`` is (target_id, target); ids are unique. A target
    of blanks only matches nothing.

    The anchors are stored and measured. Up to ``broadcast_limit`` bytes they go to the texts:
    tokens, join and check are then one stage over the texts, which are not moved. Beyond it,
    token postings are joined by shuffle, and the candidate pairs are joined with the texts.
    """
    wanted = targets.select("target_id", normalized(F.col("target")).alias("needle")).withColumn(
        "parts", tokens(F.col("needle"))
    )
    inner = F.slice("parts", 2, F.greatest(F.size("parts") - 2, F.lit(0)))
    long = wanted.where(F.size("parts") > 2).select("target_id", F.explode(F.array_distinct(inner)).alias("token"))
    short = wanted.where(F.size("parts").between(1, 2))

    bodies = texts.select("text_id", normalized(F.col("text")).alias("body"))
    # counted per task before the shuffle, so what moves is vocabulary, not text
    frequency = _postings(bodies).groupBy("token").agg(F.count("*").alias("texts"))
    # an inner token that occurs nowhere rules its target out; such a target gets frequency 0
    keys = (
        long.join(frequency, "token", "left")
        .groupBy("target_id")
        .agg(F.min_by("token", F.struct(F.coalesce("texts", F.lit(0)), "token")).alias("token"))
    )
    if not short.isEmpty():
        keys = keys.unionByName(_vocabulary_matches(short, frequency.select("token")))
    anchors = stored(keys.join(wanted.select("target_id", "needle"), "target_id"), "anchors")

    width = F.octet_length("token") + F.octet_length("needle") + 64
    if (anchors.agg(F.sum(width)).first()[0] or 0) <= broadcast_limit:
        matched = _postings(bodies, "body").join(F.broadcast(anchors), "token")
        return matched.where(F.contains("body", F.col("needle"))).select("text_id", "target_id").distinct()
    pairs = _postings(bodies).join(anchors, "token").select("text_id", "target_id", "needle").distinct()
    # the text is normalized after the join, for candidates only
    return (
        pairs.join(texts.select("text_id", "text"), "text_id")
        .where(F.contains(normalized(F.col("text")), F.col("needle")))
        .select("text_id", "target_id")
    )


def _postings(bodies: DataFrame, *keep: str) -> DataFrame:
    """(text_id, token) for each distinct token of a text."""
    return unnest(bodies, F.array_distinct(tokens(F.col("body"))), "token", "text_id", *keep)
