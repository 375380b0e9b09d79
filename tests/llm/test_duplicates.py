import hashlib
from collections import Counter

import pytest

from rankloom.llm.components import components
from rankloom.llm.near_duplicates import keep_one, layout, near_duplicates
from rankloom.llm.suffix_dedup import suffix_dedup, without_repeats
from tests.llm.edge import documents, empty, encoded, rows


def plain_repeats(docs):
    """(doc_id, n_bytes, n_removed, n_spans, digest) by a set of all 100-byte strings."""
    seen, out = set(), Counter()
    for doc, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        data, gone = encoded(text), bytearray(len(encoded(text)))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(g and not before for g, before in zip(gone, b"\0" + gone))
        out[doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def one_text_per_id(spark):
    return documents(spark).where("doc_id is not null and not (doc_id in (5, 6))")


@pytest.mark.parametrize("sizes", [(4 << 20, 24 << 20, 20_000), (20_000, 30_000, 20_000), (20_000, 30_000, 3)])
def test_suffix_dedup(spark, sizes):
    docs = one_text_per_id(spark)
    found = suffix_dedup(docs, False, *sizes).collect()
    assert Counter(tuple(r) for r in found) == plain_repeats([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_suffix_dedup_rows_and_columns(spark):
    done = without_repeats(documents(spark)).collect()
    assert len(done) == len(rows()) and done[0].asDict().keys() == documents(spark).first().asDict().keys()
    assert Counter(r["shard"] for r in done) == Counter(r[6] for r in rows())
    repeated = [r for r in done if r["doc_id"] == 5]
    assert sorted(bool(r["text"]) for r in repeated) == [False, True]  # the second of two equal rows is a repeat
    assert all(r["n_chars"] == len(r["text"] or "") for r in done)
    assert without_repeats(empty(spark)).count() == 0


def shingles(text, width):
    w = encoded(text).lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def plain_classes(docs, width, percent):
    sets = {d: shingles(t, width) for d, t in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, width, percent):
    docs = one_text_per_id(spark)
    found = near_duplicates(docs, width, percent).collect()
    want = plain_classes([(r["doc_id"], r["text"]) for r in docs.collect()], width, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_a_family_with_many_classes(spark):
    """Copies with more and more edits: chains of links, and pairs below the threshold."""
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(60):
        words = list(base)
        for j in range(k % 12):
            words[(7 * k + 11 * j) % 120] = f"e{k}_{j}"
        texts.append((k, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs, 3, 85).collect()}
    assert found == plain_classes(texts, 3, 85)
    assert len({c for _, c in found.values()}) > 5


def test_family_blocks(spark, monkeypatch):
    from rankloom.llm import near_duplicates as module

    monkeypatch.setattr(module, "BLOCK_SHINGLES", 700)
    test_a_family_with_many_classes(spark)


def test_null_and_repeated_ids(spark):
    found = near_duplicates(documents(spark)).collect()
    assert len(found) == len(rows())
    assert all(r["kept"] and r["component_id"] is None for r in found if r["doc_id"] is None)
    kept = keep_one(documents(spark)).collect()
    assert sum(r["doc_id"] == 5 for r in kept) == 1 and sum(r["doc_id"] == 6 for r in kept) == 2
    assert {r["doc_id"] for r in kept} >= {60, 61, 62, 3, 4} and not {r["doc_id"] for r in kept} & {30, 31, 32, 33, 34}
    assert keep_one(empty(spark)).count() == 0


@pytest.mark.parametrize("chunk", [500_000, 9])
def test_components(spark, chunk):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 102), (7, 7), (0, 1)] + [(200, 200 + k) for k in range(1, 30)]
    found = components(spark.createDataFrame(edges, "a long, b long"), chunk=chunk)
    want = {**{k: 0 for k in range(41)}, **dict.fromkeys((100, 101, 102), 100), **dict.fromkeys(range(200, 230), 200)}
    assert {r["node"]: r["label"] for r in found.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long"), chunk=chunk).count() == 0


def test_layout_holds_the_threshold():
    assert (layout(85), layout(80)) == ((14, 5), (15, 4))
    for percent in (70, 80, 85, 90, 95):
        chunks, size = layout(percent)
        wrong = 1 - percent / 100
        assert 2 * chunks - 1 >= wrong * chunks * size + 5 * (wrong * (1 - wrong) * chunks * size) ** 0.5
