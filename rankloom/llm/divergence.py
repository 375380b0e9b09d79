"""How far the sources of a language diverge in their terms, by hash-consed segment trees.

Spark counts terms per (lang, source) and gives each kept term of a language its place in order. A block is a
run of places, one subtree of the segment tree; a task holds the counts of a block for one tile of sources (or
two, whose pairs it prices), so its memory depends on neither the number of terms nor that of sources.

In a task all sources' subtrees are built bottom up over one table of nodes: a leaf is a count, a node the pair
of its children, and equal count subtrees, of whatever source and place, are one node. Two trees are then walked
together from their roots. The front of the walk holds each pair of nodes once, with the number of times it was
reached; equal pairs, as the empty stretches that fill most trees, are therefore opened and priced once. A pair
of leaves costs ``(p - q)^2 / (p + q)`` rounded down, with ``p`` and ``q`` from the counts and the sources' totals.
The language itself is a further tree, walked with each source's own; its leaf prices give the telling terms.

Arithmetic is exact in 64 bits: a share is found by long division in three steps of a factor of 1000, so totals
may reach 9.2e15.

Defined results: null text, lang and source count as empty strings. A group without terms, and a language without
kept terms, take part (with value 0 in the latter). Rows that repeat an id are documents of their own; ids are not
looked at. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.common import text_bytes
from rankloom.operators.positions import with_position
from rankloom.session import stored

MIN_DOCUMENTS = 10
TOP = 10
SCALE = 1_000_000_000
#: Terms of a block (a power of two) and sources of a tile: a task's counts are at most 2 * TILE x BLOCK.
BLOCK = 1024
TILE = 64
#: Languages whose figures are broadcast, some 100 bytes each; beyond that they are joined by shuffle.
BROADCAST_LANGS = 1 << 14
#: Node pairs that the front of a walk starts from at once.
WALKED = 1 << 11
#: Distinct (group, term) entries a task adds up before it hands them on.
HELD = 1 << 19

_FOLD = bytearray(b" " * 256)
_FOLD[0x41:0x5B] = _FOLD[0x61:0x7B] = bytes(range(0x61, 0x7B))
_FOLD[0x80:] = bytes(range(0x80, 0x100))
#: A-Z to a-z; a-z and all bytes of characters beyond ASCII stay; the rest separates terms.
FOLD = bytes(_FOLD)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents), added up within the task, and one row without a term per group."""
    held: dict[tuple[str, str], dict[bytes, list[int]]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in held.items():
            n = len(terms) + 1
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * n, pa.string()),
                    "source": pa.array([source] * n, pa.string()),
                    "term": pa.array([None, *terms], pa.binary()),
                    "occurrences": pa.array([0, *(c[0] for c in terms.values())], pa.int64()),
                    "documents": pa.array([0, *(c[1] for c in terms.values())], pa.int64()),
                }
            )
        held.clear()

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, text_bytes(batch.column("text"))):
            terms = held.setdefault((lang, source), {})
            before = len(terms)
            for term, n in Counter(text.translate(FOLD).split()).items():
                if entry := terms.get(term):
                    entry[0] += n
                    entry[1] += 1
                else:
                    terms[term] = [n, 1]
            size += len(terms) - before
            if size >= HELD:
                yield from flush()
                size = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, occurrences, documents); the row whose term is null says that the group exists."""
    filled = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = filled.mapInArrow(_counted, "lang string, source string, term binary, occurrences long, documents long")
    return found.groupBy("lang", "source", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("documents").alias("documents"))


def kept_terms(counts: DataFrame, least: int) -> DataFrame:
    """(lang, term, total, place): terms in at least ``least`` documents of their language, numbered from 0 in order."""
    whole = counts.where("term IS NOT NULL").groupBy("lang", "term")
    kept = whole.agg(F.sum("occurrences").alias("total"), F.sum("documents").alias("documents")).where(F.col("documents") >= least)
    placed = with_position(kept.select("lang", "term", "total"), [F.col("term")], ("lang",))
    return placed.select("lang", "term", "total", (F.col("position") - 1).alias("place"))


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(1e9 * counts / total), exactly; 0 where the total is 0."""
    safe = np.maximum(total, 1)
    rest, share = counts.copy(), np.zeros_like(counts)
    for _ in range(3):
        rest = rest * 1000
        share = share * 1000 + rest // safe
        rest %= safe
    return share + 1


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def consed(counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Subtrees over the rows of ``counts``, whose width is a power of two; -1 is a place without a term.

    The root of each row; per level, lowest first, the children (left, right) of each node; the leaves' counts."""
    leaves, nodes = np.unique(counts, return_inverse=True)
    nodes = nodes.reshape(counts.shape)
    size, levels = len(leaves), []
    while nodes.shape[1] > 1:
        pairs = nodes[:, 0::2] * size + nodes[:, 1::2]
        distinct, inverse = np.unique(pairs, return_inverse=True)
        levels.append(np.stack([distinct // size, distinct % size]))
        nodes, size = inverse.reshape(pairs.shape), len(distinct)
    return nodes[:, 0], levels, leaves


def walk(left: np.ndarray, right: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of leaves met below each pair of roots: (number of the root pair, left leaf, right leaf, times), each once."""
    owner, times = np.arange(len(left)), np.ones(len(left), np.int64)
    for children in reversed(levels):
        owner = np.concatenate([owner, owner])
        times = np.concatenate([times, times])
        left, right = children[:, left].ravel(), children[:, right].ravel()
        order = np.lexsort((right, left, owner))
        owner, left, right, times = owner[order], left[order], right[order], times[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        times = np.add.reduceat(times, np.flatnonzero(new))
        owner, left, right = owner[new], left[new], right[new]
    return owner, left, right, times


def pair_sums(roots: np.ndarray, levels: list[np.ndarray], leaves: np.ndarray, totals: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The price of trees ``a[i]`` and ``b[i]``, for each i."""
    sums = np.zeros(len(a), np.int64)
    for at in range(0, len(a), WALKED):
        one, other = a[at : at + WALKED], b[at : at + WALKED]
        owner, left, right, times = walk(roots[one], roots[other], levels)
        p = shares(leaves[left] + 2, totals[one[owner]])
        q = shares(leaves[right] + 2, totals[other[owner]])
        there = leaves[left] >= 0
        np.add.at(sums, owner + at, np.where(there, times * prices(p, q), 0))
    return sums


RESULT = "lang string, source string, part string, item string, place long, value long"


def _block(top: int, length: int):
    """Prices of one block: sums for pairs of sources, and the ``top`` places of each source."""

    def run(table: pa.Table) -> pa.Table:
        lang, block = table.column("lang")[0].as_py(), table.column("block")[0].as_py()
        first, second = table.column("tile")[0].as_py(), table.column("other")[0].as_py()
        named = table.filter(pc.is_valid(table.column("total")))
        keys = list(zip(named.column("side").to_pylist(), named.column("source").to_pylist()))
        totals = dict(zip(keys, named.column("total").to_pylist()))
        names = sorted(totals, key=lambda k: (k[0], k[1] is not None, k[1] or ""))
        number = {k: i for i, k in enumerate(names)}
        width = int(named.column("width")[0].as_py())
        columns = 1 << max(0, width - 1).bit_length()
        counts = np.zeros((len(names), columns), np.int64)
        counts[:, width:] = -1
        held = table.filter(pc.is_valid(table.column("place")))
        rows = np.array([number[k] for k in zip(held.column("side").to_pylist(), held.column("source").to_pylist())], np.int64)
        counts[rows, held.column("place").to_numpy() % length] = held.column("occurrences").to_numpy()
        size = np.array([totals[k] for k in names], np.int64)
        roots, levels, leaves = consed(counts)
        own = [i for i, k in enumerate(names) if k[0] == 0 and k[1] is not None]
        if first == second:
            i, j = np.triu_indices(len(own), 1)
            a, b = np.array(own, np.int64)[i], np.array(own, np.int64)[j]
        else:
            far = [i for i, k in enumerate(names) if k[0] == 1]
            a, b = np.repeat(own, len(far)).astype(np.int64), np.tile(far, len(own)).astype(np.int64)
        sums = pair_sums(roots, levels, leaves, size, a, b)
        out: list[tuple] = []
        for x, y, value in zip(a.tolist(), b.tolist(), sums.tolist()):
            out.append((names[x][1], "pair", names[y][1], None, value))
            out.append((names[y][1], "pair", names[x][1], None, value))
        if first == second and width:
            whole = number[(0, None)]
            owner, left, right, _ = walk(roots[own], np.full(len(own), roots[whole]), levels)
            p, q = shares(leaves[left] + 2, size[own][owner]), shares(leaves[right] + 2, np.full(len(owner), size[whole]))
            price = np.where((leaves[left] > 0) & (p > q), prices(p, q), -1)
            starts = np.searchsorted(owner, np.arange(len(own) + 1))
            for k, row in enumerate(own):
                span = slice(starts[k], starts[k + 1])
                known = left[span] * len(leaves) + right[span]  # ascending, as the walk leaves them
                met = np.searchsorted(leaves, counts[row]) * len(leaves) + np.searchsorted(leaves, counts[whole])
                value = price[span][np.searchsorted(known, met)]
                best = np.lexsort((np.arange(columns), -value))[:top]
                out += [(names[row][1], "term", None, block * length + int(x), int(value[x])) for x in best if value[x] >= 0]
        source, part, item, place, value = zip(*out) if out else [()] * 5
        return pa.table(
            {
                "lang": pa.array([lang] * len(out), pa.string()),
                "source": pa.array(source, pa.string()),
                "part": pa.array(part, pa.string()),
                "item": pa.array(item, pa.string()),
                "place": pa.array(place, pa.int64()),
                "value": pa.array(value, pa.int64()),
            }
        )

    return run


def _tiled(rows: DataFrame, tiles: Column) -> DataFrame:
    """Each row once for every pair of tiles that its source's tile is in. The language's rows (no source) go to
    the pairs of a tile with itself."""
    own = F.pmod(F.xxhash64("source"), tiles)
    every = F.sequence(F.lit(0).cast("long"), tiles - 1)
    with_each = F.transform(
        every,
        lambda t: F.when(F.col("source").isNull(), F.struct(t.alias("tile"), t.alias("other"), F.lit(0).alias("side"))).otherwise(
            F.struct(F.least(own, t).alias("tile"), F.greatest(own, t).alias("other"), F.when(own <= t, 0).otherwise(1).alias("side"))
        ),
    )
    return rows.withColumn("dealt", F.explode(with_each)).select("*", "dealt.*").drop("dealt", "tiles")


def block_prices(counts: DataFrame, terms: DataFrame, block: int = BLOCK, tile: int = TILE, top: int = TOP) -> DataFrame:
    """Sums per pair and block, candidates per source and block."""
    joined = counts.where("term IS NOT NULL").join(terms, ["lang", "term"]).select("lang", "source", "place", "occurrences")
    found = stored(joined, "divergence-counts")
    sums = found.groupBy("lang", "source").agg(F.sum("occurrences").alias("n"))
    volumes = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n"))
    groups = counts.where("term IS NULL").select("lang", "source")
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(volumes, "lang", "left").na.fill(0, ["v", "n"])
    langs = stored(langs.withColumn("tiles", F.ceil(F.col("sources") / F.lit(tile))), "divergence-langs")
    known = groups.join(sums, ["lang", "source"], "left").na.fill(0, ["n"]).select("lang", "source", "n")
    whole = langs.select("lang", F.lit(None).cast("string").alias("source"), "n")
    scale = langs.select("lang", "v", "tiles")
    if langs.count() <= BROADCAST_LANGS:
        scale = F.broadcast(scale)
    size = F.least(F.lit(block), F.col("v") - F.col("block") * block)
    numbers = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.ceil(F.col("v") / F.lit(block)) - 1))
    nothing = F.lit(None).cast("long")
    frames = known.unionByName(whole).join(scale, "lang").withColumn("block", F.explode(numbers))
    frames = frames.select("lang", "tiles", "block", "source", (F.col("n") + 2 * F.col("v")).alias("total"), size.alias("width"), nothing.alias("place"), nothing.alias("occurrences"))
    every = found.unionByName(terms.select("lang", F.lit(None).cast("string").alias("source"), "place", F.col("total").alias("occurrences")))
    entries = every.join(scale, "lang").select(
        "lang", "tiles", F.floor(F.col("place") / F.lit(block)).alias("block"), "source", nothing.alias("total"), nothing.alias("width"), "place", "occurrences"
    )
    dealt = _tiled(frames.unionByName(entries), F.col("tiles"))
    return dealt.groupBy("lang", "block", "tile", "other").applyInArrow(_block(top, block), RESULT)


def divergence(docs: DataFrame, least: int = MIN_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` for each other source of the language, part ``term`` for
    the ``top`` terms that the source uses more than its language."""
    counts = stored(term_counts(docs), "divergence-terms")
    terms = stored(kept_terms(counts, least), "divergence-kept")
    priced = stored(block_prices(counts, terms, top=top), "divergence-prices")
    pairs = priced.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "place")
    leading = priced.where("part = 'term'").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    named = leading.drop("item").join(terms.select("lang", "place", F.col("term").cast("string").alias("item")), ["lang", "place"])
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("rank", F.row_number().over(by_value)).select(columns).unionByName(named.select(columns))
