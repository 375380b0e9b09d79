"""What the fits of the quality classifier and the quality rules bring to the driver, and what they learn."""

import math
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from rankloom.llm import quality_classifier as C
from rankloom.llm import quality_rules as Q
from tests.llm.edge import documents, prose


def test_equal_rows_are_one_document_of_the_sample(spark):
    many = spark.range(30_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    others = spark.range(2, 300).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    rows = many.unionByName(others)
    assert C._smallest(rows, 8192).count() == 299
    assert C._smallest(rows, 100).count() == 100
    assert C._smallest(rows.limit(0), 100).count() == 0
    long = spark.createDataFrame([(1, "x " * C.FIT_BYTES), (2, None), (None, "short")], "doc_id long, text string")
    assert C._smallest(long, 10).count() == 2
    assert C.quality_scores(rows, C.fit(rows, 200)).count() == rows.count()


def test_labelled_rows_are_bounded(spark, monkeypatch):
    """An id with 30,000 rows, one with very many lines, one that is called good and bad."""
    seen = []
    monkeypatch.setattr(Q.Chain, "learn_share", lambda self, lines, good, rate: seen.append((len(lines), good)))
    monkeypatch.setattr(Q, "EPOCHS", 1)
    many = spark.range(30_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("a line\nand one more").alias("text"))
    own = [(2, "x\n" * (Q.FIT_LINES + 1)), (3, "### ***"), (4, "both"), (5, None), (6, "y" * (Q.FIT_BYTES + 1))]
    docs = many.unionByName(spark.createDataFrame(own, "doc_id long, text string"))
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1), (4, 0), (5, 1), (6, 1), (None, 1)], "doc_id long, quality int")
    Q.fit(docs, marks)
    assert sorted(seen) == [(1, False), (2, True)]


def brute(chain, content):
    """Marginals, expected steps and the normalising sum over all state sequences."""
    n = len(content)
    weight = {}
    for states in product((0, 1), repeat=n):
        value = chain.begin[states[0]] + sum(e for e, s in zip(content, states) if s) + sum(chain.step[i][j] for i, j in zip(states, states[1:]))
        weight[states] = math.exp(value)
    total = sum(weight.values())
    marginal = [sum(w for s, w in weight.items() if s[t]) / total for t in range(n)]
    steps = [[sum(w * sum(a == i and b == j for a, b in zip(s, s[1:])) for s, w in weight.items()) / total for j in (0, 1)] for i in (0, 1)]
    return marginal, steps


def test_expectations_equal_those_over_all_sequences():
    rng = np.random.default_rng(4)
    for n in (1, 2, 6):
        chain = Q.Chain(rng.normal(0, 1, 13).tolist(), rng.normal(0, 1, (2, 2)).tolist(), [0.0, 0.3])
        content = rng.normal(0, 1, n).tolist()
        found, want = chain.expected(content), brute(chain, content)
        assert np.allclose(found[0], want[0]) and np.allclose(found[1], want[1])


def test_a_tilted_posterior_has_the_share_and_keeps_the_order_of_lines():
    chain = Q.Chain.start()
    lines = [[0, 1], [0, 9, 11], [0, 1, 3], [0, 9]]
    for good, share in ((True, Q.GOOD_SHARE), (False, Q.BAD_SHARE)):
        marginal, _ = chain.tilted(lines, good)
        mean = sum(marginal) / len(lines)
        assert mean >= share - 1e-9 if good else mean <= share + 1e-9
        assert min(marginal[1], marginal[3]) > max(marginal[0], marginal[2])


def test_lines_of_one_document_get_their_own_states(spark):
    """The labels only call whole documents bad, half of whose lines are as in good ones."""
    junk = lambda k: f"### *** $$$ {k} %%% &&& | | <<< >>> #{k}"
    good = [(k, "\n".join(prose(3000 + 11 * k + j, 16) for j in range(6)), 1) for k in range(60)]
    bad = [(100 + k, "\n".join(junk(9 * k + j) if j != 4 else prose(5000 + k, 16) for j in range(8)), 0) for k in range(60)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in good + bad], "doc_id long, text string")
    chain = Q.fit(docs, spark.createDataFrame([(k, q) for k, _, q in good + bad], "doc_id long, quality int"))
    mixed = "\n".join([junk(1), junk(2), junk(3), *(prose(7000 + j, 20) for j in range(4)), junk(4), junk(5)]).encode()
    assert chain.decode(Q.lines_of(mixed)[0]) == [0, 0, 0, 1, 1, 1, 1, 0, 0]
    report = {r.doc_id: r for r in Q.quality_report(docs, chain).collect()}
    assert all(report[k].content_share == 1 and report[k].kept for k, _, _ in good)
    assert all(not report[k].kept for k, _, _ in bad)


def test_verdict_equals_a_plain_decoding(spark):
    """Every path over the lines of the awkward documents, tried one by one where they have few lines."""
    docs = documents(spark)
    chain = Q.Chain.start()
    checked = 0
    for r in Q.quality_report(docs, chain).join(docs.select("doc_id", "text"), "doc_id").collect():
        text = (r.text or "").encode()
        lines, sizes, _ = Q.lines_of(text)
        if 0 < len(lines) <= 8 and not r.base_failed:
            content = chain.scores(lines)
            value = lambda s: chain.begin[s[0]] + sum(e for e, x in zip(content, s) if x) + sum(chain.step[i][j] for i, j in zip(s, s[1:]))  # noqa: B023, E731
            best = max(product((0, 1), repeat=len(lines)), key=value)
            share = sum(n for n, s in zip(sizes, best) if s) / sum(sizes)
            assert (r.content_share, r.kept) == (share, share >= Q.CONTENT_SHARE)
            checked += 1
    assert checked > 10
