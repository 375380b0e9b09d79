"""Exact duplicates, filter audit and source divergence against plain versions, on documents with every awkward case."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import divergence as V
from rankloom.llm import exact_dedup as X
from rankloom.llm import filter_audit as A
from tests.llm.edge import documents, empty, prose, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EXTRA = [(200, "Same Case É"), (201, "same case É"), (202, "same case é"), (203, ""), (204, None), (9, "river"), (9, "River"), (9, "river")]


def cased(spark, parts=4):
    schema = "doc_id long, text string, lang string, source string, key string, row long, size int, record string"
    listed = [(r[0], r[1]) for r in rows()] + EXTRA
    return spark.createDataFrame([(k, t, "en", f"s{n % 3}", "clash", n, 1, "clash") for n, (k, t) in enumerate(listed)], schema).repartition(parts), listed


def equals(listed, fold):
    groups = defaultdict(list)
    for n, (k, t) in enumerate(listed):
        body = t or ""
        groups[body.translate(LOWER) if fold else body].append((k, n))
    return groups


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, keep, weak):
    """``weak``: a hash that tells only lengths modulo 7 apart, so that most groups hold different texts."""
    df, listed = cased(spark)
    options = {"digest": lambda t: F.unhex(F.md5((F.octet_length(t) % 7).cast("string")))} if weak else {}
    want = Counter()
    for body, members in equals(listed, True).items():
        ids = [k for k, _ in members if k is not None]
        chosen = (min(ids) if keep == "smallest" else max(ids)) if ids else None
        stays = False
        for k in sorted((k for k, _ in members), key=lambda k: (k != chosen, k or -1)):
            want[(k, chosen, len(members), not stays, hashlib.sha256(body.encode()).hexdigest())] += 1
            stays = True
    for filter_keys in (X.FILTER_KEYS, 0):
        found = X.duplicate_report(df, keep=keep, filter_keys=filter_keys, **options).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found) == want


def test_one_of_each_stays_with_all_columns(spark):
    df, listed = cased(spark)
    kept = X.drop_copies(df, keep="largest")
    assert kept.columns == df.columns
    found = [(r.text or "").translate(LOWER) for r in kept.collect()]
    assert sorted(found) == sorted(equals(listed, True))
    assert X.drop_copies(empty(spark)).count() == 0 == X.duplicate_report(empty(spark)).count()
    strings = spark.createDataFrame([("b", "x"), ("a", "X"), (None, "x")], "doc_id string, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in X.duplicate_report(strings).collect()} == {("a", "a", True), ("b", "a", False), (None, "a", False)}


def labelled(spark):
    listed = [(k, k % 2, None) for k in range(0, 70, 2)] + [(k, None, 1) for k in range(0, 70, 5)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (999, 1, 1), (8, 1, 1), (8, 1, 1)]
    return spark.createDataFrame(listed, "doc_id long, quality int, toxic int"), listed


def audited(listed, labels):
    """part -> [(failed letters, good, toxic)]"""
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, x in labels if x == 1}
    out = defaultdict(list)
    firsts: dict = {}
    for k, t, _ in listed:
        if k is not None:
            firsts[t or ""] = min(firsts.get(t or "", k), k)
    for k, t, part in listed:
        text = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = "".join(
            letter
            for letter, fails in (
                ("A", len(words) < 200),
                ("B", 100 * len(set(words)) < 50 * len(words)),
                ("C", 100 * len(re.findall("[A-Z]", text)) > 2 * len(text)),
                ("D", bool(re.search("[#$%&*|]", text))),
                ("E", k is not None and k > firsts[text]),
            )
            if fails
        )
        out[part or ""].append((failed, k is not None and k in good, k is not None and k in toxic))
    return out


def steps(members):
    total = {f: 0 for f in "ABCDE"}
    rows_of = []
    for order in map("".join, permutations("ABCDE")):
        left = members
        for n, f in enumerate(order):
            out = [m for m in left if f in m[0]]
            left = [m for m in left if f not in m[0]]
            total[f] += len(out)
            rows_of.append([order, n + 1, len(left), len(out), sum(f in m[0] for m in members) - len(out), sum(m[0] == f for m in members), sum(m[1] for m in out), sum(m[2] for m in out), f])
    return {(*r[:8], total[r[8]]) for r in rows_of}


def test_filter_audit(spark):
    labels, listed_labels = labelled(spark)
    listed = [(r[0], r[1], r[3] if n % 7 else None) for n, r in enumerate(rows())] + [(300 + k, prose(40 + k, 260).upper() + "#" * (k % 2), "s1") for k in range(5)]
    schema = "doc_id long, text string, source string, part string, mask string, good int"
    df = spark.createDataFrame([(*r, "clash", "clash", 7) for r in listed], schema).repartition(4)
    found = A.filter_audit(df, labels).collect()
    want = audited(listed, listed_labels)
    assert len(found) == 600 * len(want) and len({m[0] for x in want.values() for m in x}) > 6
    by_part = defaultdict(set)
    for r in found:
        by_part[r.part].add((r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley))
    assert by_part == {part: steps(members) for part, members in want.items()}
    assert A.filter_audit(empty(spark), labels).count() == 0
    assert A.filter_audit(df, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_contraction_of_many_parts():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 1 << 40, (130, 3, 32))
    found = A.step_figures(counts)
    for k in (0, 129):
        one = A.step_figures(counts[k : k + 1])
        assert all((one[c][0] == found[c][k]).all() for c in A.FIGURES)
    last = np.arange(4, 600, 5)
    assert (found["kept"][:, last] == counts[:, 0, :1]).all()  # behind the last step only what passes all is left
    assert (found["shapley"].reshape(-1, 120, 5).sum(axis=2) == found["removed"].sum(axis=1)[:, None]).all()


def price(p, q):
    return (p - q) ** 2 // (p + q)


def diverging(listed, least, top):
    counts, groups, seen = defaultdict(Counter), set(), defaultdict(Counter)
    for text, lang, source in listed:
        lang, source = lang or "", source or ""
        terms = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups.add((lang, source))
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted((t for t, n in seen[lang].items() if n >= least), key=str.encode)
        sources = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(-sum(price(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            out |= {(lang, s, "pair", o.decode(), -v, k + 1) for k, (v, o) in enumerate(sorted(pairs))}
            terms = [(-price(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out |= {(lang, s, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(sorted(terms)[:top])}
    return out


@pytest.mark.parametrize("block,tile", [(1024, 64), (4, 2), (1, 1)])
def test_divergence(spark, monkeypatch, block, tile):
    listed = [(r[1], ["en", "de", None][n % 3], f"s{n % 5}" if n % 11 else None) for n, r in enumerate(rows())]
    listed += [("Öl öl ÉTÉ été x_y " * 3, "fr", f"t{k % 2}") for k in range(4)] + [("", "it", "a"), (None, "it", "b"), ("alone", "es", "one")]
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in listed], "text string, lang string, source string, term string, place int, total int").repartition(3)
    made = V.block_prices
    monkeypatch.setattr(V, "block_prices", lambda counts, terms, top: made(counts, terms, block=block, tile=tile, top=top))
    monkeypatch.setattr(V, "HELD", 50)
    monkeypatch.setattr(V, "WALKED", 3)
    for least, top in ((4, 10), (1, 2)) if block > 1 else ((4, 3),):
        found = {tuple(r) for r in V.divergence(df, least, top).select("lang", "source", "part", "item", "value", "rank").collect()}
        assert found == diverging(listed, least, top)
    assert V.divergence(empty(spark)).count() == 0


def test_equal_subtrees_are_one_node_and_priced_once():
    counts = np.zeros((3, 1 << 12), np.int64)
    counts[0, 7], counts[1, 7], counts[2, 4000] = 5, 5, 5
    roots, levels, leaves = V.consed(counts)
    assert roots[0] == roots[1] != roots[2]
    assert sum(x.shape[1] for x in levels) <= 3 * 12 + 12  # an empty subtree, and the paths to the three counts, per level
    owner, left, right, times = V.walk(roots[[0, 0]], roots[[1, 2]], levels)
    assert times.sum() == 2 << 12 and len(owner) == 2 + 3
    totals = np.array([5 + (2 << 12)] * 3)
    share = lambda c: 1 + 10**9 * (c + 2) // int(totals[0])
    assert V.pair_sums(roots, levels, leaves, totals, np.array([0, 0]), np.array([1, 2])).tolist() == [0, 2 * price(share(5), share(0))]


def test_shares_are_exact():
    rng = np.random.default_rng(1)
    total = rng.integers(1, 9 * 10**15, 2000)
    counts = (total * rng.random(2000)).astype(np.int64)
    assert V.shares(counts, total).tolist() == [1 + 10**9 * c // t for c, t in zip(counts.tolist(), total.tolist())]


def test_hot_rows_are_collapsed_in_their_tasks(spark):
    """A third of the rows share text and group: what is shuffled for them is a row per task."""
    df = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("one text")).otherwise(F.concat(F.lit("t"), "id")).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source")
    )
    found = X.duplicate_report(df.repartition(4), keep="largest")
    assert found.where("group_size > 1").count() == 10_000 and found.where("kept").count() == 20_001
    assert V.divergence(df).where("part = 'term'").count() <= 10
