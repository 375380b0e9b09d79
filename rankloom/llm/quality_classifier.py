"""Quality and toxicity scores from weak labels.

Heuristic labellers vote good, bad or abstain on every document. Expectation-maximisation over the table
of vote patterns (at most ``3 ** labellers`` rows, whatever the corpus) estimates how often each labeller gives each
vote on good and on bad documents, and from that the posterior of every pattern. A logistic scorer over
hashed words, word endings and coarse figures is then trained on posteriors as soft labels and scores every
document by its whole text. One such model is made for quality and one for toxicity; the table ``labels`` is not used.

The scorer is trained on at most ``FIT_DOCUMENTS`` different documents of at most ``FIT_BYTES`` bytes each, those with the
smallest hash of id and text; rows that are equal in both count as one there, however many they are. Patterns and
posteriors cover all documents, and so do the scores.

Null and empty texts get the labellers' votes for no words and a score from the figures alone. Repeated rows
get equal scores. Null ids are ordinary values. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import slices, text_bytes
from rankloom.llm.words import SPACE, Words, mix, words_of

FIT_DOCUMENTS, FIT_BYTES = 8192, 32 << 10
DIMENSIONS = 1 << 18
EPOCHS, RATE, SHRINK = 6, 0.5, 1e-6
ROUNDS, PRIOR, OWN_FAULT = 60, 2.0, 0.98
BLOCK = 2 << 20
GOOD, BAD, NONE = 1, 2, 0

COMMON = (
    b"the of and to in a is that it for was on are as with be by this from at "
    b"le la les de des du et en un une que qui dans pour est pas sur au par avec "
    b"der die das und ist nicht ein eine mit von zu auf den sich im dem auch als "
    b"el los las y por con para se su al lo como no es del"
)
#: English, French, German, Spanish.
INSULTS = {
    "insult": (
        "idiot idiots moron morons loser losers clown clowns fool fools jerk jerks imbecile coward bastard "
        "idiote idiotes crétin crétins imbécile imbéciles abruti abrutis connard connards salaud "
        "idioten trottel dummkopf vollidiot arschloch versager feigling spinner "
        "idiotas imbécil imbéciles cretino cretinos payaso payasos cobarde cabrón gilipollas"
    ).encode(),
    "dehumanise": (
        "scum trash vermin filth garbage parasite parasites subhuman rats cockroach cockroaches "
        "racaille ordure ordures vermine cafard cafards déchets "
        "abschaum ungeziefer dreck parasiten untermensch kakerlaken gesindel "
        "escoria basura alimaña alimañas parásito parásitos cucarachas chusma"
    ).encode(),
    "demean": (
        "stupid worthless pathetic disgusting dumb useless ugly hateful revolting shameful "
        "stupide stupides minable dégoûtant pathétique honteux "
        "dumm wertlos erbärmlich widerlich nutzlos hässlich "
        "estúpido estúpida patético asqueroso despreciable repugnante"
    ).encode(),
}


def _hashes(text: bytes) -> np.ndarray:
    return np.unique(words_of([text]).hash)


_COMMON = _hashes(COMMON)
_INSULTS = {name: _hashes(text) for name, text in INSULTS.items()}


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def figures(texts: list[bytes], w: Words) -> dict[str, np.ndarray]:
    """Coarse figures of each text."""
    n = w.counts
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])

    def of_bytes(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int64)])
        return np.diff(total[edges])

    def of_words(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return np.diff(total[w.first])

    def bytes_in(chars: bytes) -> np.ndarray:
        table = np.zeros(256, bool)
        table[list(chars)] = True
        return table

    last = w.data[w.end - 1]
    size = w.end - w.start
    ink = of_bytes(~SPACE)
    upper = bytes_in(bytes(range(65, 91)))
    letters = upper | bytes_in(bytes(range(97, 123))) | (np.arange(256) >= 0x80)
    bare = (size == 1) & (last == ord("|"))
    again = np.zeros(len(w.hash), bool)
    again[1:] = w.hash[1:] == w.hash[:-1]
    again[w.first[:-1][n > 0]] = False
    double = (last == ord("!")) & (w.data[np.maximum(w.end - 2, 0)] == ord("!")) & (size > 2)
    found = {
        "words": n,
        "signs": _share(of_bytes(bytes_in(b"#*$%&|<>")), ink),
        "upper": _share(of_bytes(upper), of_bytes(letters)),
        "bars": _share(of_words(bare), n),
        "marks": _share(of_words(double), n),
        "common": _share(of_words(_within(w.hash, _COMMON)), n),
        "length": _share(ink, n),
        "stops": _share(of_words(np.isin(last, np.frombuffer(b".?!", np.uint8)) & ~double), n),
        "digits": _share(of_bytes(bytes_in(b"0123456789")), ink),
        "echo": _share(of_words(again), n),
    }
    for name, known in _INSULTS.items():
        found[name] = of_words(_plain_hits(w, known))
    return found


def _plain_hits(w: Words, known: np.ndarray) -> np.ndarray:
    """Words that are in the list once a closing mark is taken off."""
    hit = _within(w.hash, known)
    last = w.data[w.end - 1]
    marked = np.flatnonzero(np.isin(last, np.frombuffer(b".,;:!?", np.uint8)) & (w.end - w.start > 3) & (w.end - w.start < 16))
    if len(marked):
        words = [w.data[a:z].tobytes() for a, z in zip(w.start[marked].tolist(), (w.end[marked] - 1).tolist())]
        hit[marked] = _within(words_of([b"\n".join(words)]).hash, known) if all(words) else False
    return hit


def _vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, NONE))


#: Below so many words, labellers that judge shares of words abstain from "bad".
FEW = 20

#: Labellers of quality and of toxicity ("bad" is toxic), by name.
QUALITY = {
    "signs": lambda f: _vote(f["signs"] > 0.08, f["signs"] < 0.02),
    "upper": lambda f: _vote((f["upper"] > 0.4) & (f["words"] >= FEW), f["upper"] < 0.15),
    "bars": lambda f: _vote(f["bars"] > 0.2, f["bars"] < 0.02),
    "marks": lambda f: _vote(f["marks"] > 0.2, f["marks"] < 0.02),
    "common": lambda f: _vote((f["common"] < 0.05) & (f["words"] >= FEW), f["common"] > 0.15),
    "length": lambda f: _vote(((f["length"] < 2) | (f["length"] > 12)) & (f["words"] >= FEW), (f["length"] > 3.5) & (f["length"] < 9)),
    "stops": lambda f: _vote((f["stops"] < 0.005) & (f["words"] >= FEW), (f["stops"] > 0.02) & (f["stops"] < 0.3)),
    "digits": lambda f: _vote(f["digits"] > 0.2, f["digits"] < 0.02),
    "echo": lambda f: _vote(f["echo"] > 0.2, f["echo"] < 0.05),
}
TOXICITY = {
    "insult": lambda f: _vote(f["insult"] > 0, f["insult"] == 0),
    "dehumanise": lambda f: _vote(f["dehumanise"] > 0, f["dehumanise"] == 0),
    "demean": lambda f: _vote(f["demean"] > 0, f["demean"] == 0),
    "several": lambda f: _vote(f["insult"] + f["dehumanise"] + f["demean"] > 1, f["insult"] + f["dehumanise"] + f["demean"] == 0),
}


def pattern(labellers: dict, found: dict[str, np.ndarray]) -> np.ndarray:
    """All votes of a document as one number, three values a place."""
    code = np.zeros(len(found["words"]), np.int64)
    for vote in labellers.values():
        code = code * 3 + vote(found)
    return code


def votes_of(code: np.ndarray, labellers: int) -> np.ndarray:
    return np.stack([code // 3**k % 3 for k in range(labellers - 1, -1, -1)], 1)


def posteriors(code: np.ndarray, count: np.ndarray, labellers: int) -> np.ndarray:
    """Probability of "good" for each pattern, by expectation-maximisation.

    There is one kind of good document and, since most labellers know a single fault and find the others good, one kind
    of bad document per labeller. Each kind has a share and, for every labeller, the rates of its two votes; an
    abstention says nothing. A labeller finds its own fault in ``OWN_FAULT`` of the cases or more."""
    votes = votes_of(code, labellers)
    bad = votes == BAD
    share = np.where(bad.any(1)[:, None], np.hstack([np.full((len(code), 1), 0.1), 0.9 * bad / np.maximum(bad.sum(1), 1)[:, None]]), 0.01 / labellers)
    share[~bad.any(1), 0] = 0.99
    one_hot = (votes[:, :, None] == [GOOD, BAD]).astype(float)
    for _ in range(ROUNDS):
        weight = share * count[:, None]
        size = weight.sum(0)
        given = np.einsum("ic,ijk->cjk", weight, one_hot)
        rate = (given + PRIOR / 2) / (given.sum(2, keepdims=True) + PRIOR)
        own = np.arange(labellers)
        rate[own + 1, own, 1] = np.maximum(rate[own + 1, own, 1], OWN_FAULT)
        rate[own + 1, own, 0] = 1 - rate[own + 1, own, 1]
        logs = np.log((size + 1) / (size.sum() + 1 + labellers)) + np.einsum("ijk,cjk->ic", one_hot, np.log(rate))
        share = np.exp(logs - logs.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
    return share[:, 0]


def _features(w: Words, found: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of all texts, and where each text's begin (one more at the end)."""
    owner = w.owner().astype(np.uint64)
    tail = w.data[w.end - 1].astype(np.uint64) * np.uint64(256) + w.data[np.maximum(w.end - 2, 0)]
    size = np.uint64(DIMENSIONS)
    texts = np.arange(len(found["words"]), dtype=np.uint64)
    columns = [owner * size + w.hash % size, owner * size + mix(tail + np.uint64(1 << 33)) % size]
    for k, name in enumerate(("signs", "upper", "bars", "marks", "common", "stops", "digits", "echo")):
        step = np.minimum(found[name] * 20, 12).astype(np.uint64)
        columns.append(texts * size + mix(np.uint64(k * 64 + 7) * np.uint64(1 << 34) + step) % size)
    both = np.unique(np.concatenate(columns))
    return (both % size).astype(np.int32), np.searchsorted(both, texts * size).tolist() + [len(both)]


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, feature: np.ndarray, first: list[int]) -> np.ndarray:
        total = np.add.reduceat(self.weights[feature], first[:-1])
        z = self.bias + total / np.sqrt(np.diff(first))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(samples: list[np.ndarray], target: np.ndarray) -> Scorer:
    """Logistic regression on soft labels by stochastic gradient steps; both classes weigh the same."""
    scorer = Scorer(np.zeros(DIMENSIONS), 0.0)
    history = np.ones(DIMENSIONS)
    share = float(np.clip(target.mean(), 0.01, 0.99)) if len(target) else 0.5
    rng = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(samples)):
            own, y = samples[k], target[k]
            norm = 1 / np.sqrt(len(own))
            p = 1 / (1 + np.exp(-np.clip(scorer.bias + scorer.weights[own].sum() * norm, -30, 30)))
            g = (p - y) * (y / share + (1 - y) / (1 - share)) / 2
            history[own] += (g * norm) ** 2
            scorer.weights[own] -= RATE * (g * norm / np.sqrt(history[own]) + SHRINK * scorer.weights[own])
            scorer.bias -= 0.02 * g
    return scorer


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words, dict]]:
    for rows in batches:
        texts = text_bytes(rows.column("text"))
        for a, z in slices([len(t) for t in texts], BLOCK):
            w = words_of(texts[a:z])
            yield rows.slice(a, z - a), w, figures(texts[a:z], w)


def _patterns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, found in _blocks(batches):
        both = np.stack([pattern(QUALITY, found), pattern(TOXICITY, found)], 1)
        distinct, count = np.unique(both, axis=0, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(distinct[:, 0]), pa.array(distinct[:, 1]), pa.array(count, pa.int64())], names=["quality", "toxicity", "n"])


def _sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, w, found in _blocks(batches):
        feature, first = _features(w, found)
        lists = [feature[a:z].tobytes() for a, z in zip(first, first[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lists, pa.binary()), pa.array(pattern(QUALITY, found)), pa.array(pattern(TOXICITY, found))], names=["features", "quality", "toxicity"]
        )


@dataclass
class WeakModel:
    """Posteriors by pattern and a scorer, for quality and for toxicity ("good" is not toxic)."""

    code: tuple[np.ndarray, np.ndarray]
    posterior: tuple[np.ndarray, np.ndarray]
    scorer: tuple[Scorer, Scorer]

    def belief(self, which: int, code: np.ndarray) -> np.ndarray:
        return self.posterior[which][np.searchsorted(self.code[which], code)]


def fit(docs: DataFrame, bound: int = FIT_DOCUMENTS) -> WeakModel:
    rows = docs.select("doc_id", "text")
    table = rows.mapInArrow(_patterns, "quality long, toxicity long, n long").groupBy("quality", "toxicity").agg(F.sum("n").alias("n")).collect()
    codes, beliefs = [], []
    for k, labellers in enumerate((QUALITY, TOXICITY)):
        seen = np.array([[r[k], r["n"]] for r in table], np.int64).reshape(-1, 2)
        code, back = np.unique(seen[:, 0], return_inverse=True)
        count = np.bincount(back, seen[:, 1], len(code))
        codes.append(code)
        beliefs.append(posteriors(code, count, len(labellers)))
    sample = _smallest(rows, bound).mapInArrow(_sample, "features binary, quality long, toxicity long").collect()
    sample = sorted(sample, key=lambda r: (r["quality"], r["toxicity"], bytes(r["features"])))  # as bounded as the sample
    features = [np.frombuffer(r["features"], np.int32) for r in sample]
    scorers = []
    for k, name in enumerate(("quality", "toxicity")):
        own = np.array([r[name] for r in sample], np.int64)
        scorers.append(train(features, beliefs[k][np.searchsorted(codes[k], own)] if len(own) else np.zeros(0)))
    return WeakModel(tuple(codes), tuple(beliefs), tuple(scorers))


def _smallest(rows: DataFrame, bound: int) -> DataFrame:
    """One row for each of the ``bound`` smallest hashes of rows that may be fitted on. Hashes are ranked alone; then the
    texts up to the last one are read, and equal rows become one in the task that reads them."""
    short = rows.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= FIT_BYTES).withColumn("h", F.xxhash64(F.lit(3), "doc_id", "text"))
    last = short.select("h").distinct().orderBy("h").limit(bound).agg(F.max("h").alias("h")).first()["h"]
    known = short.where(F.col("h") <= F.lit(last)) if last is not None else short.limit(0)
    return known.groupBy("h").agg(F.min("text").alias("text")).drop("h")


def quality_scores(docs: DataFrame, model: WeakModel) -> DataFrame:
    """doc_id, quality_label (posterior), quality_score, toxic_label, toxic_score and kept, for every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, w, found in _blocks(batches):
            feature, first = _features(w, found)
            quality, clean = (s.score(feature, first) for s in model.scorer)
            label = [model.belief(k, pattern(labellers, found)) for k, labellers in enumerate((QUALITY, TOXICITY))]
            kept = (quality >= 0.5) & (clean >= 0.5)
            arrays = [rows.column("doc_id"), *[pa.array(x, pa.float64()) for x in (label[0], quality, 1 - label[1], 1 - clean)], pa.array(kept)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "quality_label", "quality_score", "toxic_label", "toxic_score", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, quality_label double, quality_score double, toxic_label double, toxic_score double, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
