"""Near-duplicates of word-shingle sets by a multi-index Hamming join.

A document's set of shingles is summed up by ``K`` minimum hashes of ``b`` = 16 bits each; the Hamming distance of
two signatures counts the places that differ. The first ``chunks * rows`` places are split into chunks.
If two signatures differ in at most ``2 * chunks - 1`` of them, some chunk has one error at most (pigeonhole), so
each chunk is indexed once per place that is allowed to be wrong: the other places make the key. All pairs within
the distance meet in a key. The number of chunks is chosen so that a pair at the similarity threshold is
within the distance up to ``SIGMAS`` standard deviations.

Documents with equal sets are one node. In each key, every node is first paired with the key's least node,
and its most frequent partner is verified on the full sets; that gives most of a group its class without
pairs inside it. Keys whose nodes are still in different classes are joined into families, and each family is
compared exactly: its sets are dealt to blocks of ``BLOCK_SHINGLES``, and each pair of blocks counts intersections by an
inverted index in one task, which returns only links that join two classes. Pairs within one class need no
look, since they cannot change it. No key, group or class is capped, and pairs never become rows.

Null and empty texts have no set, are linked with nothing and kept. Rows without doc_id likewise. Rows
of one doc_id with different texts are linked as separate documents. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import slices, text_bytes, text_slices
from rankloom.llm.components import components
from rankloom.llm.words import mix, words_of
from rankloom.session import small_batches, stored

WIDTH, PERCENT = 5, 80
#: Shingles of a block; a task holds two blocks, or two documents if these are longer.
BLOCK_SHINGLES = 2 << 20
K = 128
SIGMAS = 5.3
BLOCK = 2 << 20

_SEEDS = np.random.default_rng(0xB17)
_FACTORS = _SEEDS.integers(1, 2**63, K, dtype=np.uint64) | np.uint64(1)
_TERMS = _SEEDS.integers(1, 2**63, K, dtype=np.uint64)


def layout(percent: int) -> tuple[int, int]:
    """(chunks, places in a chunk) for a similarity threshold."""
    wrong = 1 - percent / 100
    rows = min(5, int(0.8 / wrong + 1e-9))
    chunks = 1
    while 2 * chunks - 1 < wrong * rows * chunks + SIGMAS * math.sqrt(wrong * (1 - wrong) * rows * chunks):
        chunks += 1
    if rows < 2 or rows * chunks > K:
        raise ValueError(f"no layout for a similarity of {percent} percent")
    return chunks, rows


def shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of all texts, sorted within each, and where each text's begin
    (one more at the end). A text with fewer words than ``width`` has its whole sequence as one shingle."""
    w = words_of(texts)
    n = w.counts
    size = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(texts)), size)
    first = np.cumsum(size) - size
    at = w.first[:-1][owner] + np.arange(len(owner)) - first[owner]
    length = np.minimum(width, n)[owner]
    h = w.hash
    key = np.full(len(owner), 0x51, np.uint64)
    for k in range(width):
        inside = k < length
        part = h[np.minimum(at + k, max(len(h) - 1, 0))] if len(h) else h
        key = np.where(inside, mix(key * np.uint64(0x9E3779B97F4A7C15) + part), key)
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[fresh], owner[fresh]
    return key, np.searchsorted(owner, np.arange(len(texts) + 1))


def signatures(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """K 16-bit minimum hashes of each non-empty set, as rows."""
    out = np.empty((len(first) - 1, K), np.uint16)
    base = mix(key)
    for k in range(K):
        h = base * _FACTORS[k] + _TERMS[k]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9E3779B97F4A7C15)
        out[:, k] = mix(np.minimum.reduceat(h, first[:-1])) & np.uint64(0xFFFF)
    return out


def _sets(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for a, z, texts in text_slices(rows.column("text"), BLOCK):
                key, first = shingles(texts, width)
                size = np.diff(first)
                full = np.flatnonzero(size)
                starts = np.append(first[:-1][full], len(key))
                nodes: list[int | None] = [None] * (z - a)
                packed: list[bytes | None] = [None] * (z - a)
                if len(full):
                    signed = signatures(key, starts)
                    for row, k in enumerate(full.tolist()):
                        digest = blake2b(key[first[k] : first[k + 1]].tobytes(), digest_size=8).digest()
                        nodes[k], packed[k] = int.from_bytes(digest, "little", signed=True), signed[row].tobytes()
                arrays = [rows.column("doc_id").slice(a, z - a), rows.column("text_key").slice(a, z - a), pa.array(size, pa.int64()), pa.array(nodes, pa.int64()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", "n_shingles", "node", "signature"])

    return run


def chunk_keys(signed: np.ndarray, chunks: int, rows: int) -> np.ndarray:
    """All index keys of each signature: for each chunk and each place of it that may be wrong, the rest."""
    columns = []
    for c in range(chunks):
        places = signed[:, c * rows : (c + 1) * rows].astype(np.uint64)
        for wrong in range(rows):
            key = np.zeros(len(signed), np.uint64)
            for r in range(rows):
                if r != wrong:
                    key = key << np.uint64(16) | places[:, r]
            columns.append(mix(key ^ mix(np.full(1, c * rows + wrong + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
    return np.stack(columns, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, K)


def _index(chunks: int, rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, len(b), 2000):
                part = b.slice(a, 2000)
                keys = chunk_keys(_matrix(part.column("signature")), chunks, rows)
                nodes = np.repeat(part.column("node").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(keys.ravel().astype(np.int64))], names=["node", "key"])

    return run


def _confirm(width: int, percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = text_bytes(b.column("text_a")), text_bytes(b.column("text_b"))
            keep = np.zeros(len(b), bool)
            for a, z in slices([len(x) + len(y) for x, y in zip(left, right)], BLOCK):
                key, first = shingles(left[a:z] + right[a:z], width)
                n = z - a
                for k in range(n):
                    x, y = key[first[k] : first[k + 1]], key[first[n + k] : first[n + k + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[a + k] = both and 100 * both >= percent * (len(x) + len(y) - both)
            yield b.select(["a", "b"]).filter(pa.array(keep))

    return run


def verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough."""
    where = nodes.select("node", "rep.doc_id", "rep.text_key")
    placed = pairs.join(where.select(F.col("node").alias("a"), F.col("doc_id").alias("doc_a"), F.col("text_key").alias("key_a")), "a")
    placed = placed.join(where.select(F.col("node").alias("b"), F.col("doc_id").alias("doc_b"), F.col("text_key").alias("key_b")), "b")
    left = texts.select(F.col("doc_id").alias("doc_a"), F.col("text_key").alias("key_a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("doc_b"), F.col("text_key").alias("key_b"), F.col("text").alias("text_b"))
    both = placed.join(right, ["doc_b", "key_b"]).join(left, ["doc_a", "key_a"]).select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_confirm(width, percent), "a long, b long").distinct()


def joining_links(left: list[np.ndarray], right: list[np.ndarray] | None, class_left: np.ndarray, class_right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs (place in left, place in right) of similar sets that join classes, as few as join all that can be.

    Without ``right``, pairs within ``left``. The members of the largest class are compared with others, not
    among themselves."""
    inside = right is None
    if inside:
        right, class_right = left, class_left
    distinct, number = np.unique(np.concatenate([class_left, class_right]), return_inverse=True)
    parent = np.arange(len(distinct))
    mine, theirs = number[: len(left)], number[len(left) :]

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    largest = np.bincount(number).argmax()
    swap = False
    if not inside and (mine != largest).sum() > (theirs != largest).sum():
        left, right, mine, theirs, swap = right, left, theirs, mine, True
    size = np.array([len(x) for x in right], np.int64)
    key = np.concatenate(right) if right else np.zeros(0, np.uint64)
    order = np.argsort(key, kind="stable")
    owner = np.repeat(np.arange(len(right)), size)[order]
    known, first = np.unique(key[order], return_index=True)
    edges = np.append(first, len(key))
    links = []

    def compare(x: int, among: np.ndarray) -> None:
        own = left[x]
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        at = at[known[at] == own]
        if not len(at):
            return
        start, count = edges[at], edges[at + 1] - edges[at]
        after = np.cumsum(count)
        places = np.repeat(start - (after - count), count) + np.arange(after[-1])
        both = np.bincount(owner[places], minlength=len(right))
        for y in np.flatnonzero((100 * both >= percent * (len(own) + size - both)) & among & (both > 0)).tolist():
            a, b = root(mine[x]), root(theirs[y])
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((y, x) if swap else (x, y))

    everyone = np.ones(len(right), bool)
    for x in np.flatnonzero(mine != largest).tolist():
        compare(x, everyone)
    if not inside:  # what is left: members of the largest class on one side, others on the other
        others = theirs != largest
        if others.any():
            for x in np.flatnonzero(mine == largest).tolist():
                compare(x, others)
    return links


def _families(width: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        nodes, label, block = (table.column(c).to_numpy() for c in ("node", "label", "block"))
        order = np.lexsort((nodes, block))
        texts = text_bytes(table.column("text"))
        sets: list[np.ndarray] = []
        ordered = [texts[k] for k in order]
        for a, z in slices([len(t) for t in ordered], BLOCK):
            key, first = shingles(ordered[a:z], width)
            sets += [key[first[k] : first[k + 1]] for k in range(z - a)]
        nodes, label, block = nodes[order], label[order], block[order]
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        cut = int((block == i).sum())
        if i == j:
            links = joining_links(sets, None, label, label, percent)
            pairs = [(nodes[x], nodes[y]) for x, y in links]
        else:
            links = joining_links(sets[:cut], sets[cut:], label[:cut], label[cut:], percent)
            pairs = [(nodes[x], nodes[cut + y]) for x, y in links]
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    return run


def family_links(shared: DataFrame, label: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes of different classes that share a key."""
    at = stored(shared.select("key", "node").join(label, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label")), "placed")
    split = at.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least != most").select("key", "least")
    mixed = stored(at.join(split, "key").select("node", "label", "least").distinct(), "mixed")
    family = components(mixed.select("least", "label").distinct(), "least", "label").toDF("label", "family")
    members = mixed.select("node", "label").distinct().join(family, "label").join(nodes.select("node", "n", "rep"), "node")
    blocks = members.groupBy("family").agg(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = members.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64(F.lit(7), "node"), "blocks").cast("int"))
    placed = placed.select("family", "node", "label", "block", "blocks", F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_key").alias("text_key"))
    with_text = placed.join(texts, ["doc_id", "text_key"]).dropDuplicates(["node"])
    dealt = with_text.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "label", "block", "text")
    return dealt.groupBy("family", "i", "j").applyInArrow(_families(width, percent), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id (least doc_id of the class) and kept, for every row."""
    chunks, rows = layout(percent)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    sets = stored(small_batches(texts).mapInArrow(_sets(width), f"doc_id {kind}, text_key long, n_shingles long, node long, signature binary"), "sets")
    linked = sets.where("node is not null and doc_id is not null")
    nodes = linked.groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("rep"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
    nodes = stored(nodes, "nodes")

    index = nodes.select("node", "signature").mapInArrow(_index(chunks, rows), "node long, key long")
    heads = index.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("members")).where("members > 1")
    shared = stored(index.join(heads, "key").select("key", "node", "head"), "shared")

    partner = shared.where("node != head").groupBy("node", "head").agg(F.count("*").alias("keys"))
    first = partner.groupBy("node").agg(F.max_by("head", F.struct("keys", "head")).alias("head"))
    stars = stored(verified(first.select(F.col("head").alias("a"), F.col("node").alias("b")), nodes, texts, width, percent), "stars")
    rest = family_links(shared, components(stars), nodes, texts, width, percent)
    classes = components(stars.unionByName(rest))

    named = nodes.select("node", "rep.doc_id").join(classes, "node", "left").select("node", "doc_id", F.coalesce("label", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of = named.join(least, "label").select("node", "component_id")
    joined = sets.select("doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")).join(of, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their class; of rows that repeat doc_id and text, one."""
    own = [F.col("doc_id").alias("_kept_doc"), F.col("text_key").alias("_kept_text")]
    kept = stored(near_duplicates(docs, **options).where("kept").groupBy(*own).agg(F.count("*").alias("_times")), "kept")
    match = docs["doc_id"].eqNullSafe(kept["_kept_doc"]) & (F.xxhash64(docs["text"]) == kept["_kept_text"])
    once = docs.join(kept.where("_times = 1"), match, "left_semi")
    often = docs.join(kept.where("_times > 1"), match, "left_semi")
    return once.unionByName(often.dropDuplicates(["doc_id", "text"]))
