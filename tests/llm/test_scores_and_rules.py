import math
import zlib
from collections import Counter

import numpy as np

from rankloom.llm.language_model import lm_scores, score, start, tokens_of
from rankloom.llm.quality_classifier import QUALITY, fit as weak_fit, posteriors, quality_scores
from rankloom.llm.quality_rules import Chain, fit, keep_good, quality_report
from tests.llm.edge import documents, empty, encoded, rows

SYMBOLS = set("#*$%&|<>")


def plain_measures(text):
    w = encoded(text).split()
    whole = (text or "").split("\n")
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines, dup = set(), 0
    for line in whole:
        if line.encode().split():
            dup += line in lines
            lines.add(line)
    return len(w), sum(len(x.decode()) for x in w), sum(c in SYMBOLS for c in text or ""), dup, len(covered)


def labels(spark):
    return spark.createDataFrame([(k, 1, 0) for k in range(20)] + [(71, 0, 0), (67, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


def test_quality_rules(spark):
    docs = documents(spark)
    found = quality_report(docs, fit(docs, labels(spark))).collect()
    base = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in found)
    assert base == Counter((r[0], *plain_measures(r[1])) for r in rows())
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert all(by_id[k]["kept"] for k in range(8, 20)) and not by_id[71]["kept"]
    kept = keep_good(docs, fit(docs, labels(spark)))
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in found)
    assert quality_report(empty(spark), fit(empty(spark), labels(spark))).count() == 0


def test_faults_of_some_bad_documents_do_not_spoil_the_rest(spark):
    """Most bad documents repeat a word; their lines end like sentences. Clean ones stay."""
    from tests.llm.edge import prose

    clean = [(k, "\n".join(prose(1000 + 9 * k + j, 18) for j in range(6)), 1) for k in range(80)]
    echo = [(100 + k, f"{prose(2000 + k, 12)}\n" + "\n".join(f"{w} " * 20 + f"{w}." for w in ("stone", "amber", "river")), 0) for k in range(30)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in clean + echo], "doc_id long, text string")
    marks = spark.createDataFrame([(k, q) for k, _, q in clean + echo], "doc_id long, quality int")
    chain = fit(docs, marks)
    kept = {r["doc_id"] for r in keep_good(docs, chain).collect()}
    assert kept == {k for k, _, _ in clean}


def test_decoding_is_the_best_path():
    chain = Chain.start()
    rng = np.random.default_rng(2)
    for _ in range(20):
        lines = [sorted(rng.choice(13, 3, replace=False).tolist()) for _ in range(7)]

        def value(states):
            s = chain.scores(lines)
            return chain.begin[states[0]] + sum(x * y for x, y in zip(s, states)) + sum(chain.step[a][b] for a, b in zip(states, states[1:]))

        best = max(value([code >> k & 1 for k in range(7)]) for code in range(128))
        assert abs(value(chain.decode(lines)) - best) < 1e-9


def test_learning_raises_the_likelihood():
    lines, states = [[0, 1], [0, 9], [0, 1], [0, 9, 11]], [0, 1, 0, 1]
    chain = Chain.start()
    for _ in range(200):
        chain.learn(lines, states, 0.5)
    assert chain.decode(lines) == states


def test_weak_labels(spark):
    docs = documents(spark)
    model = weak_fit(docs)
    found = quality_scores(docs, model).collect()
    assert len(found) == len(rows())
    by_id = {r["doc_id"]: r for r in found}
    assert not by_id[71]["kept"] and all(0 <= r["quality_score"] <= 1 for r in found)
    assert quality_scores(empty(spark), weak_fit(empty(spark))).count() == 0


def test_posteriors_find_faults_that_few_labellers_know():
    """Two votes against must not be outvoted by the labellers of other faults."""
    n = len(QUALITY)
    good = sum(3**k for k in range(n))
    single = [good + 3**k for k in range(n)]
    double = [good + 3**k + 3 ** ((k + 1) % n) for k in range(n)]
    p = posteriors(np.array([good, *single, *double]), np.array([9000] + [120] * n + [20] * n), n)
    assert p[0] > 0.9 and (p[-n:] < 0.2).all() and (p[1 : n + 1] < p[0]).all()


def held(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1


def test_language_model(spark):
    docs = documents(spark)
    found = lm_scores(docs).collect()
    tokens = lambda t: encoded(t).lower().split() + [None]
    counts = Counter(w for r in rows() if not held(r[0]) for w in tokens(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for r in rows():
        w = tokens(r[1])
        base = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)
        want[r[0], held(r[0]), len(w), sum(counts[x] > 0 for x in w), total, round(base, 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == want
    assert all(r["score"] < 0 for r in found)
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)
    assert lm_scores(empty(spark)).count() == 0


def test_model_sums_to_one(spark):
    from rankloom.llm.language_model import CLASSES, END_CLASS, SUBS, VOCABULARY, _chosen, _count, _logits, _rows, _summed, steps_of

    texts = [encoded(r[1]) for r in rows()]
    df = spark.createDataFrame([(t.decode(),) for t in texts], "text string")
    vocabulary = df.mapInArrow(_count(3), "bucket long, hashes binary, counts binary, kinds binary").groupBy("bucket").applyInArrow(_summed, VOCABULARY)
    model = start(vocabulary)
    rng = np.random.default_rng(5)
    for w in model.weights:
        w[:] = rng.normal(0, 0.3, w.shape)
    # over all classes and sub-classes, behind one context
    cells, inner = np.repeat(np.arange(CLASSES), SUBS), np.tile(np.arange(SUBS), CLASSES)
    once = (cells > END_CLASS) | (inner == 0)
    cells, inner = cells[once], inner[once]
    context = np.repeat(rng.integers(0, 2**63, (3, 1), dtype=np.uint64), len(cells), 1)
    logs = np.zeros(len(cells))
    for number, step in enumerate(steps_of(cells, inner)):
        at = _rows(context[:, step.at], number, step.state, model.rows)
        logs[step.at] += _chosen(_logits(model.weights[number], at, model.offsets[number], step.state), step.target)
    assert abs(np.exp(logs).sum() - 1) < 1e-4
    words = sorted({w for t in texts for w in t.lower().split()})
    t = tokens_of([b" ".join(words)])
    table: dict[int, int] = {}
    for r in vocabulary.collect():
        table.update(zip(np.frombuffer(r["hashes"], np.uint64).tolist(), np.frombuffer(r["counts"], "<u8").tolist()))
    kind = model.classes(t)
    c = np.array([table[h] for h in t.hash.tolist()], float)
    inside = np.zeros(len(model.size))
    np.add.at(inside, kind, (c - model.discount[kind]) / model.size[kind])
    inside += (10**model.rare).sum(1)
    assert np.allclose(inside[model.size > 0], 1)
    hashes = np.array(sorted(table), np.uint64)
    n, known, base, own = score(model, [b"unknownword"], hashes, np.array([table[h] for h in hashes.tolist()], np.uint64))
    assert n[0] == 2 and known[0] == 1 and own[0] < 0


def test_words_of_a_class_follow_the_context(spark):
    """Pairs of words with equal last bytes and counts, each seen behind one word only."""
    from rankloom.llm.language_model import VOCABULARY, _count, _summed, trained

    pairs = [(f"left{k}", f"right{k}", f"{k}parrot", f"{k}carrot") for k in range(8)]
    texts = [f"common{k}" for k in range(40) for _ in range(60)]
    texts += [f"{a} {x}" for p in pairs for a, x in (p[::2], p[1::2]) for _ in range(20)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(1)
    vocabulary = df.mapInArrow(_count(1), "bucket long, hashes binary, counts binary, kinds binary").groupBy("bucket").applyInArrow(_summed, VOCABULARY).cache()
    model = start(vocabulary)
    row = vocabulary.first()
    hashes, counts = np.frombuffer(row["hashes"], np.uint64), np.frombuffer(row["counts"], "<u8")
    for _ in range(12):
        model = trained(model, df)
    of = lambda a, x: score(model, [f"{a} {x}".encode()], hashes, counts)[3][0]
    gained = [of(a, x) + of(b, y) - of(a, y) - of(b, x) for a, b, x, y in pairs]
    assert np.mean(gained) > 0.3


def test_sub_classes_sum_to_one(spark):
    from rankloom.llm.language_model import END_CLASS, VOCABULARY, _count, _summed, sub_of

    df = documents(spark).select("text").where("text is not null")
    vocabulary = df.mapInArrow(_count(1), "bucket long, hashes binary, counts binary, kinds binary").groupBy("bucket").applyInArrow(_summed, VOCABULARY).cache()
    model, row = start(vocabulary), vocabulary.first()
    counts = dict(zip(np.frombuffer(row["hashes"], np.uint64).tolist(), np.frombuffer(row["counts"], "<u8").tolist()))
    t = tokens_of([b" ".join(sorted({w for r in df.collect() for w in encoded(r["text"]).lower().split()}))])
    kind, sub = model.classes(t), sub_of(t.hash)
    mass = 10**model.rare
    np.add.at(mass, (kind, sub), (np.array([counts[h] for h in t.hash.tolist()], float) - model.discount[kind]) / model.size[kind])
    assert np.allclose(mass[END_CLASS + 1 :], np.exp(model.share[END_CLASS + 1 :]), atol=1e-6)
    assert np.allclose(mass[END_CLASS + 1 :].sum(1), 1)
