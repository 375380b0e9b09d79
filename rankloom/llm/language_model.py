"""Text scores by a hashed maximum-entropy model with a class-factored softmax.

    P(word | context) = P(class | context) * P(sub-class | class, context) * P(word | sub-class)

The class of a word is its own if it is one of the most frequent, else one of ``SIGNATURES`` by its last bytes; the
infrequent words of a class fall into ``SUBS`` sub-classes by their hash. Class and sub-class are predicted in two steps
each, a group and a place in the group, so that four small softmaxes stand for 128 classes of up to 16 sub-classes. Each
has hashed features of the context, each hashed with what is already decided: the word before, the pair of classes
before (n-gram), and the pair of classes two and four places back (skip). Their weights start at zero above the counts'
shares and come from gradient steps over all training documents: each task takes steps on its own partition from the
common weights, and the tasks' weights are averaged by tokens, first over a slice for a start, then over all. The rows of
weights follow the size of the vocabulary. Inside a sub-class, words follow their counts with an
absolute discount and without regard to the context; the discounted mass is the probability of an unknown word there, so the model
sums to one over all known words and "unknown, of class k and sub-class s".

Word counts cover every training document. They live in a table of packed buckets, as many as the corpus
asks for; a group of documents asks the buckets for the counts of its distinct words, and nothing that grows
with the corpus goes to the driver: only the weights, class sums and the most frequent words do.

A document trains unless crc32 of its id as text leaves 1 modulo 5. Null text is empty and has the end token
alone; a null id counts as the empty text. Rows of one id are scored each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import bucket_of, parts, slices, text_bytes, total_bytes
from rankloom.llm.words import mix, words_of
from rankloom.session import stored

FOLDS, HELD = 5, 1
FREQUENT, SIGNATURES = 63, 64
CLASSES = FREQUENT + 1 + SIGNATURES  #: the end token has a class of its own
END_CLASS = FREQUENT
SUBS = 16  #: sub-classes of the infrequent words of a class
#: Outcomes of the four steps: group of the class, class in the group, group of the sub-class, sub-class in the group.
WIDTHS = (8, CLASSES // 8, 4, SUBS // 4)
#: Words of the vocabulary for each row of weights (of each of the three kinds of features and four steps), and the least and
#: most rows: every task sends all of them once a round.
WORDS_PER_ROW, LEAST_ROWS, MOST_ROWS = 1 << 10, 1 << 14, 1 << 16
BATCH, RATE, SLICE = 8192, 0.35, 8
COUNT_BYTES, GROUP_BYTES, BUCKET_BYTES = 8 << 20, 4 << 20, 32 << 20
END = np.uint64(1)
CHUNK = 1 << 14  #: weights that are averaged together
_U = np.uint64


@dataclass
class Tokens:
    hash: np.ndarray  #: of each token, the end tokens included
    kind: np.ndarray  #: class, for infrequent words
    first: np.ndarray  #: of each text, its first token; one more at the end


def tokens_of(texts: list[bytes]) -> Tokens:
    w = words_of(texts)
    n = w.counts
    total = len(w.hash) + len(texts)
    first = np.concatenate([[0], np.cumsum(n + 1)])
    ends = first[1:] - 1
    word = np.ones(total, bool)
    word[ends] = False
    tail = w.data[w.end - 1].astype(np.int64)
    for back in (2, 3):
        at = w.end - back
        tail = tail * 256 + np.where(at >= w.start, w.data[np.maximum(at, 0)], 0)
    out = Tokens(np.full(total, END), np.full(total, END_CLASS, np.uint8), first)
    out.hash[word] = w.hash
    out.kind[word] = (FREQUENT + 1 + mix(tail.astype(np.uint64)) % _U(SIGNATURES)).astype(np.uint8)
    return out


def sub_of(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ _U(SUBS)) % _U(SUBS)).astype(np.int64)


def packed(hashes: np.ndarray, buckets: int, *others: np.ndarray) -> tuple[pa.Array, list[pa.Array]]:
    """Bucket numbers, and for each array its part in each bucket, as bytes."""
    bucket = ((hashes >> _U(20)) % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    distinct, first = np.unique(bucket[order], return_index=True)
    edges = np.append(first, len(order))
    columns = []
    for x in (hashes, *others):
        x = x[order]
        columns.append(pa.array([x[a:z].tobytes() for a, z in zip(edges, edges[1:])], pa.binary()))
    return pa.array(distinct, pa.int64()), columns


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _count(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = text_bytes(rows.column(0))
            for a, z in slices([len(t) for t in texts], COUNT_BYTES):
                t = tokens_of(texts[a:z])
                distinct, at, count = np.unique(t.hash, return_index=True, return_counts=True)
                bucket, columns = packed(distinct, buckets, count.astype("<u8"), t.kind[at])
                yield pa.RecordBatch.from_arrays([bucket, *columns], names=["bucket", "hashes", "counts", "kinds"])

    return run


def _summed(table: pa.Table) -> pa.Table:
    """One bucket of the vocabulary, its most frequent words, and its sums by class and sub-class."""
    hashes, counts, kinds = _joined(table.column("hashes"), _U), _joined(table.column("counts"), "<u8"), _joined(table.column("kinds"), np.uint8)
    distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
    total = np.zeros(len(distinct), np.uint64)
    np.add.at(total, back, counts)
    kind = kinds[at]
    words = np.flatnonzero(distinct != END)
    top = words[np.lexsort((distinct[words], -total[words].astype(np.int64)))[:FREQUENT]]
    cell = kind.astype(np.int64) * SUBS + sub_of(distinct)
    sums = [np.bincount(cell, w, CLASSES * SUBS).astype(np.int64).tolist() for w in (total, np.ones(len(kind)), total == 1, total == 2)]
    frequent = [{"hash": int(h), "count": int(c), "kind": int(k)} for h, c, k in zip(distinct[top].astype(np.int64), total[top], kind[top])]
    return pa.table(
        {
            "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int64()),
            "hashes": pa.array([distinct.tobytes()], pa.binary()),
            "counts": pa.array([total.tobytes()], pa.binary()),
            "frequent": pa.array([frequent], pa.list_(pa.struct([("hash", pa.int64()), ("count", pa.int64()), ("kind", pa.int32())]))),
            "sums": pa.array([[list(x) for x in zip(*sums)]], pa.list_(pa.list_(pa.int64()))),
        }
    )


VOCABULARY = "bucket long, hashes binary, counts binary, frequent array<struct<hash:long,count:long,kind:int>>, sums array<array<long>>"


@dataclass
class Model:
    frequent: np.ndarray  #: sorted hashes of the words with a class of their own; class k is place k
    tokens: int  #: training tokens
    distinct: int
    discount: np.ndarray  #: by class
    size: np.ndarray  #: training tokens by class
    share: np.ndarray  #: log of each sub-class's share of its class
    rare: np.ndarray  #: log10 probability of an unknown word of each sub-class, given the class
    offsets: list[np.ndarray]  #: of each step, log shares of its outcomes; one row per state that it starts from
    weights: list[np.ndarray]  #: of each step; rows: the three tables one after the other

    @property
    def rows(self) -> int:
        return len(self.weights[0]) // 3

    def copy(self) -> Model:
        return replace(self, offsets=[self.offsets[0].copy(), *self.offsets[1:]], weights=[w.copy() for w in self.weights])

    def classes(self, t: Tokens) -> np.ndarray:
        kind = t.kind.copy()
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, t.hash), len(self.frequent) - 1)
            own = self.frequent[at] == t.hash
            kind[own] = at[own]
        return kind

    def contexts(self, t: Tokens, kind: np.ndarray) -> np.ndarray:
        """Hashes of each token's three contexts; before a text stands the end token."""
        n = len(t.hash)
        since = np.arange(n) - np.repeat(t.first[:-1], np.diff(t.first))
        wide = kind.astype(np.uint64)

        def back(x: np.ndarray, k: int, start) -> np.ndarray:
            out = np.full(n, start, x.dtype)
            out[k:] = np.where(since[k:] >= k, x[:-k], start)
            return out

        one, two, four = (back(wide, k, _U(END_CLASS)) for k in (1, 2, 4))
        return np.stack([mix(back(t.hash, 1, END)), mix(one * _U(CLASSES) + two + _U(1 << 40)), mix(two * _U(CLASSES) + four + _U(1 << 41))])


@dataclass
class Step:
    """One softmax over a run of tokens: which tokens take it, the state they start from, and what comes out."""

    at: np.ndarray | slice
    state: np.ndarray
    target: np.ndarray


def steps_of(kind: np.ndarray, sub: np.ndarray) -> list[Step]:
    """The four steps of tokens of these classes and sub-classes. The last two are taken by infrequent words only."""
    kind = kind.astype(np.int64)
    every, rare = slice(None), np.flatnonzero(kind > END_CLASS)
    group, inside = kind // WIDTHS[1], kind % WIDTHS[1]
    far, near = sub[rare] // WIDTHS[3], sub[rare] % WIDTHS[3]
    return [
        Step(every, np.zeros(len(kind), np.int64), group),
        Step(every, group, inside),
        Step(rare, kind[rare], far),
        Step(rare, kind[rare] * WIDTHS[2] + far, near),
    ]


def _rows(context: np.ndarray, number: int, state: np.ndarray, rows: int) -> np.ndarray:
    """Rows of weights in each of the three tables of a step, as short integers, which sort fast."""
    salt = (state + (number << 20) + 1).astype(np.uint64) * _U(0x9E3779B97F4A7C15)
    return (((context ^ salt) * _U(0xFF51AFD7ED558CCD)) >> _U(40) & _U(rows - 1)).astype(np.uint16)


def _logits(weights: np.ndarray, rows: np.ndarray, offsets: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Within what ``exp`` can take, so that no row needs its maximum."""
    n = len(weights) // 3
    out = weights[:n].take(rows[0], 0, mode="clip")
    out += weights[n : 2 * n].take(rows[1], 0, mode="clip")
    out += weights[2 * n :].take(rows[2], 0, mode="clip")
    out += offsets.take(state, 0, mode="clip") if len(offsets) > 1 else offsets
    return np.clip(out, -80, 80, out=out)


def _sums(p: np.ndarray) -> np.ndarray:
    return p @ np.ones(p.shape[1], p.dtype)


def _row_sums(p: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``p`` in ``order``, by segment; most segments have one row, which is only copied."""
    size = np.diff(np.append(first, len(order)))
    out = p.take(order[first], 0, mode="clip")
    many = np.flatnonzero(size > 1)
    if len(many):
        inside = np.repeat(size > 1, size)
        begin = np.cumsum(size[many]) - size[many]
        out[many] = np.add.reduceat(p.take(order[inside], 0, mode="clip"), begin)
    return out


def _step(weights: np.ndarray, history: np.ndarray, rows: np.ndarray, offsets: np.ndarray, state: np.ndarray, target: np.ndarray) -> np.ndarray:
    """One gradient step; the step of a row of weights falls with the squares of its gradients."""
    n, size = len(target), len(weights) // 3
    p = _logits(weights, rows, offsets, state)
    np.exp(p, out=p)
    p /= _sums(p)[:, None]
    p[np.arange(n), target] -= 1
    for k, own in enumerate(rows):
        order = np.argsort(own, kind="stable")
        ranked = own[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        mine = ranked[first].astype(np.int64) + k * size
        gradient = _row_sums(p, order, first)
        squares = history.take(mine) + np.einsum("ij,ij->i", gradient, gradient)
        history[mine] = squares
        gradient *= (RATE / np.sqrt(squares))[:, None]
        weights[mine] = weights.take(mine, 0, mode="clip") - gradient
    return p


def learn(model: Model, texts: list[bytes], history: list[np.ndarray]) -> int:
    """Gradient steps over the texts."""
    t = tokens_of(texts)
    kind, sub = model.classes(t), sub_of(t.hash)
    context = model.contexts(t, kind)
    for a in range(0, len(kind), BATCH):
        z = min(a + BATCH, len(kind))
        for number, step in enumerate(steps_of(kind[a:z], sub[a:z])):
            if len(step.target):
                rows = _rows(context[:, a:z][:, step.at], number, step.state, model.rows)
                p = _step(model.weights[number], history[number], rows, model.offsets[number], step.state, step.target)
                if number == 0:
                    model.offsets[0] -= p.sum(0) * np.float32(0.05 / (z - a))
    return len(kind)


def _packed_weights(model: Model) -> np.ndarray:
    return np.concatenate([model.offsets[0].ravel(), *(w.ravel() for w in model.weights)])


def _with_weights(model: Model, flat: np.ndarray) -> Model:
    out, at = model.copy(), 0
    for x in (out.offsets[0], *out.weights):
        x[:] = flat[at : at + x.size].reshape(x.shape)
        at += x.size
    return out


def _steps(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = model.copy()
        history = [np.ones(len(w), np.float32) for w in own.weights]
        seen = 0
        for rows in batches:
            texts = text_bytes(rows.column(0))
            for a, z in slices([len(x) for x in texts], 1 << 20):
                seen += learn(own, texts[a:z], history)
        if seen:
            flat = _packed_weights(own)
            chunks = [flat[k : k + CHUNK] for k in range(0, len(flat), CHUNK)]
            count = len(chunks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(count), pa.int32()),
                    pa.array([TaskContext.get().partitionId() % 1024] * count, pa.int32()),
                    pa.array([seen] * count, pa.int64()),
                    pa.array([c.astype(np.float16).tobytes() for c in chunks], pa.binary()),
                ],
                names=["chunk", "part", "tokens", "weights"],
            )

    return run


def _averaged(table: pa.Table) -> pa.Table:
    tokens = table.column("tokens").to_pylist()
    total = sum(tokens)
    mean = sum(np.frombuffer(w, np.float16).astype(np.float64) * (n / total) for w, n in zip(table.column("weights").to_pylist(), tokens))
    keys = {c: pa.array([table.column(c)[0].as_py()], pa.int32()) for c in ("chunk", "part")}
    return pa.table({**keys, "tokens": pa.array([total], pa.int64()), "weights": pa.array([mean.astype(np.float16).tobytes()], pa.binary())})


def trained(model: Model, texts: DataFrame) -> Model:
    """The model after one round: steps in each task, then the mean over tasks in two levels."""
    schema = "chunk int, part int, tokens long, weights binary"
    moved = texts.mapInArrow(_steps(model), schema)
    mean = moved.groupBy("chunk", "part").applyInArrow(_averaged, schema).groupBy("chunk").applyInArrow(_averaged, schema)
    rows = sorted(mean.select("chunk", "weights").collect())
    return _with_weights(model, np.concatenate([np.frombuffer(r["weights"], np.float16) for r in rows])) if rows else model


def start(vocabulary: DataFrame) -> Model:
    """Classes and their sums from the vocabulary; weights of zero."""
    listed = vocabulary.select(F.explode("frequent").alias("w")).select("w.*")
    top = listed.orderBy(F.desc("count"), "hash").limit(FREQUENT).collect()
    by_class = vocabulary.select(F.posexplode("sums").alias("kind", "s")).groupBy("kind").agg(*[F.sum(F.col("s")[k]).alias(f"s{k}") for k in range(4)])
    cells = np.zeros((CLASSES * SUBS, 4), np.float64)
    for r in by_class.collect():
        cells[r["kind"]] = r[1:]
    cells = cells.reshape(CLASSES, SUBS, 4)
    tokens, distinct = int(cells[..., 0].sum()), int(cells[..., 1].sum())
    top = sorted(top, key=lambda r: r["hash"] % (1 << 64))
    for place, r in enumerate(top):
        own = np.array([r["count"], 1, r["count"] == 1, r["count"] == 2], np.float64)
        sub = sub_of(np.array([r["hash"] % (1 << 64)], np.uint64))[0]
        cells[r["kind"], sub] -= own
        cells[place, sub] = own
    cells = np.maximum(cells, 0)
    n, _, once, twice = cells.sum(1).T
    signature = np.arange(CLASSES) > END_CLASS
    discount = np.where(signature, (once + 0.5) / (once + 2 * twice + 1), 0.0)
    n = n + signature  # an unknown word of a class without any is possible too
    part = signature[:, None] / SUBS
    held = np.maximum(cells[..., 0] + part, 1e-300)
    with np.errstate(divide="ignore"):
        rare = np.log10((discount[:, None] * cells[..., 1] + part) / np.maximum(n, 1e-300)[:, None])
    share = np.where(signature[:, None], np.log(held / np.maximum(n, 1e-300)[:, None]), 0).astype(np.float32)
    groups = held.reshape(CLASSES, WIDTHS[2], WIDTHS[3])
    flat = lambda x: np.log(np.maximum(x, 1e-300) / np.maximum(x.sum(1, keepdims=True), 1e-300)).astype(np.float32)
    sizes = np.maximum(n, 0.5).reshape(WIDTHS[0], WIDTHS[1])
    offsets = [flat(sizes.sum(1)[None]), flat(sizes), flat(groups.sum(2)), flat(groups.reshape(-1, WIDTHS[3]))]
    frequent = np.array([r["hash"] % (1 << 64) for r in top], np.uint64)
    rows = LEAST_ROWS
    while rows < MOST_ROWS and rows * WORDS_PER_ROW < distinct:
        rows *= 2
    weights = [np.zeros((3 * rows, width), np.float32) for width in WIDTHS]
    return Model(frequent, tokens, distinct, discount, n, share, rare, offsets, weights)


def _asked(buckets: int):
    """A group's distinct words, by bucket of the vocabulary."""

    def run(table: pa.Table) -> pa.Table:
        distinct = np.unique(tokens_of(text_bytes(table.column("text"))).hash)
        bucket, (hashes,) = packed(distinct, buckets)
        return pa.table({"bucket": bucket, "g": pa.array([table.column("g")[0].as_py()] * len(bucket), pa.int64()), "hashes": hashes})

    return run


def _answered(asked: pa.Table, vocabulary: pa.Table) -> pa.Table:
    hashes = _joined(vocabulary.column("hashes"), _U)
    counts = _joined(vocabulary.column("counts"), "<u8")
    groups, known, numbers = [], [], []
    for g, own in zip(asked.column("g").to_pylist(), asked.column("hashes").to_pylist()):
        own = np.frombuffer(own, _U)
        at = np.minimum(np.searchsorted(hashes, own), max(len(hashes) - 1, 0))
        found = hashes[at] == own if len(hashes) else np.zeros(len(own), bool)
        groups.append(g)
        known.append(own[found].tobytes())
        numbers.append(counts[at[found]].tobytes() if found.any() else b"")
    return pa.table({"g": pa.array(groups, pa.int64()), "hashes": pa.array(known, pa.binary()), "counts": pa.array(numbers, pa.binary())})


def _chosen(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log probability of each row's target."""
    picked = x[np.arange(len(x)), target]
    np.exp(x, out=x)
    return picked - np.log(_sums(x))


def score(model: Model, texts: list[bytes], hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each text: tokens, known tokens, base score, model score. ``hashes`` ascend."""
    t = tokens_of(texts)
    kind = model.classes(t)
    at = np.minimum(np.searchsorted(hashes, t.hash), max(len(hashes) - 1, 0))
    known = hashes[at] == t.hash if len(hashes) else np.zeros(len(t.hash), bool)
    c = np.where(known, counts[at].astype(np.float64) if len(hashes) else 0.0, 0.0)
    base = np.log10((c + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))
    with np.errstate(divide="ignore", invalid="ignore"):
        sub = sub_of(t.hash)
        inside = np.where(known, np.log10(np.maximum(c - model.discount[kind], 1e-12) / model.size[kind]), model.rare[kind, sub])
    context = model.contexts(t, kind)
    chosen = np.zeros(len(kind))
    for a in range(0, len(kind), BATCH):
        z = min(a + BATCH, len(kind))
        part = chosen[a:z]
        for number, step in enumerate(steps_of(kind[a:z], sub[a:z])):
            if len(step.target):
                rows = _rows(context[:, a:z][:, step.at], number, step.state, model.rows)
                part[step.at] += _chosen(_logits(model.weights[number], rows, model.offsets[number], step.state), step.target)
    rare = kind > END_CLASS
    chosen[rare] -= model.share[kind[rare], sub[rare]]
    chosen = chosen / np.log(10) + np.where(np.isfinite(inside), inside, 0.0)
    chosen = np.where(np.isfinite(inside), chosen, base)  # only without any training text
    first = t.first[:-1]
    add = lambda x: np.add.reduceat(x, first) if len(first) else np.zeros(0)
    return np.diff(t.first), add(known.astype(np.int64)), add(base), add(chosen)


def _scored(model: Model):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, counts = _joined(answers.column("hashes"), _U), _joined(answers.column("counts"), "<u8")
        order = np.argsort(hashes)
        hashes, counts = hashes[order], counts[order]
        texts = text_bytes(table.column("text"))
        found = [score(model, texts[a:z], hashes, counts) for a, z in slices([len(x) for x in texts], 1 << 20)]
        columns = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0)] * 4
        n = len(texts)
        arrays = [table.column("doc_id"), table.column("held_out"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64())]
        arrays += [pa.array([model.tokens] * n, pa.int64()), pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.float64())]
        return pa.table(arrays, names=names)

    return run


def held_out(key: str = "doc_id") -> Column:
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % FOLDS == HELD


def fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the vocabulary's buckets, from the training documents."""
    training = docs.where(~held_out()).select("text")
    buckets = parts(total_bytes(docs), BUCKET_BYTES)
    counts = training.mapInArrow(_count(buckets), "bucket long, hashes binary, counts binary, kinds binary")
    vocabulary = stored(counts.groupBy("bucket").applyInArrow(_summed, VOCABULARY), "vocabulary")
    model = start(vocabulary)
    part = F.pmod(F.xxhash64(F.lit(6), "text"), F.lit(SLICE)) == 0
    return trained(trained(model, training.where(part)), training), vocabulary


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    rows = docs.select("doc_id", "text")
    model, vocabulary = fit(rows)
    total = total_bytes(rows)
    dealt = rows.withColumn("held_out", held_out()).withColumn("g", bucket_of(6, parts(total, GROUP_BYTES), "doc_id", F.xxhash64("text")).cast("long"))
    by_group = dealt.groupBy("g")
    asked = by_group.applyInArrow(_asked(parts(total, BUCKET_BYTES)), "bucket long, g long, hashes binary")
    answers = asked.groupBy("bucket").cogroup(vocabulary.select("bucket", "hashes", "counts").groupBy("bucket")).applyInArrow(_answered, "g long, hashes binary, counts binary")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return by_group.cogroup(answers.groupBy("g")).applyInArrow(_scored(model), schema)
