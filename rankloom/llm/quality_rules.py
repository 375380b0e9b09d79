"""Quality rules by line labelling with a linear-chain conditional random field.

Each line of a text gets observations (signs, letters, repeats, length, ending); a two-state chain, whose weights
are fitted to labelled documents by gradient steps on its likelihood, marks lines as content or
boilerplate by Viterbi decoding. A document is kept when at least ``CONTENT_SHARE`` of its bytes lie in
content lines and the base rules hold: ``MIN_WORDS`` words, and at most half of the words in repeated
three-word windows.

The fit uses at most ``FIT_DOCUMENTS`` labelled documents of at most ``FIT_LINES`` lines and ``FIT_BYTES`` bytes, those
with the smallest hash of their id, in the classes' own proportion; of several rows of an id, one. All else covers every
row. Without labels of both classes the starting weights hold. A label says something of a document, not of its
lines: a good one has at least ``GOOD_SHARE`` of its lines in content, a bad one at most ``BAD_SHARE``. The lines' own states
are latent. Expectation-maximisation takes the field's posterior over them, tilted towards content or boilerplate just as
far as the document's share asks, and steps towards its expectations; so a bad document may keep good lines, and
lines of one document are told apart.

Null text: no words, so it fails. White space alone: likewise. Repeated rows get the same verdict each.
Other columns are passed through or ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import text_bytes, text_slices
from rankloom.llm.words import mix, words_of
from rankloom.session import small_batches

MIN_WORDS = 50
REPEAT_PERCENT = 50
CONTENT_SHARE = 0.5
FIT_DOCUMENTS, FIT_LINES, FIT_BYTES = 2000, 200, 64 << 10
GOOD_SHARE, BAD_SHARE = 0.9, 0.2
TILTS = 7  #: halvings of the search for a tilt, between 0 and MOST_TILT
MOST_TILT = 16.0
EPOCHS, RATE, SHRINK = 4, 0.1, 1e-4
BLOCK = 1 << 20

SIGNS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
BLANK = b" \t\n\x0b\x0c\r"

#: Observations of a line, each with its weight for "content" before fitting.
OBSERVATIONS = {
    "any": 0.5,
    "many_signs": -3.0,
    "some_signs": -0.5,
    "shouting": -2.0,
    "marks": -2.0,
    "many_digits": -1.0,
    "bars": -2.0,
    "markup": -2.0,
    "repeated": -1.0,
    "sentence_end": 1.0,
    "short": -0.2,
    "long": 0.5,
    "echo": -3.0,
}


@dataclass
class Chain:
    """Weights of the content state (boilerplate has zero) and of the steps between states."""

    weights: list[float]
    step: list[list[float]]
    begin: list[float]

    @classmethod
    def start(cls) -> Chain:
        return cls(list(OBSERVATIONS.values()), [[0.5, -0.5], [-0.5, 0.5]], [0.0, 0.0])

    def add(self, other: Chain, share: float) -> None:
        self.weights = [w + share * o for w, o in zip(self.weights, other.weights)]
        self.begin = [w + share * o for w, o in zip(self.begin, other.begin)]
        self.step = [[w + share * o for w, o in zip(x, y)] for x, y in zip(self.step, other.step)]

    def scores(self, lines: list[list[int]]) -> list[float]:
        w = self.weights
        return [sum(w[k] for k in line) for line in lines]

    def decode(self, lines: list[list[int]]) -> list[int]:
        """The most likely states (1: content)."""
        if not lines:
            return []
        (s00, s01), (s10, s11) = self.step
        content = self.scores(lines)
        a, b = self.begin[0], self.begin[1] + content[0]
        back = []
        for e in content[1:]:
            from0, from1 = a + s00 < b + s10, a + s01 < b + s11
            back.append((from0, from1))
            a, b = (b + s10 if from0 else a + s00), (b + s11 if from1 else a + s01) + e
        state = int(b >= a)
        states = [state]
        for choice in reversed(back):
            state = int(choice[state])
            states.append(state)
        return states[::-1]

    def expected(self, content: list[float]) -> tuple[list[float], list[list[float]]]:
        """Probability of content for each line, and expected numbers of steps between states (forward-backward), for
        lines of these content scores."""
        n, step = len(content), self.step
        (s00, s01), (s10, s11) = step
        add = lambda x, y: max(x, y) + math.log1p(math.exp(-abs(x - y)))
        forward = [(self.begin[0], self.begin[1] + content[0])]
        for e in content[1:]:
            a, b = forward[-1]
            forward.append((add(a + s00, b + s10), add(a + s01, b + s11) + e))
        whole = add(*forward[-1])
        marginal = [math.exp(forward[-1][1] - whole)] * n
        steps = [[0.0, 0.0], [0.0, 0.0]]
        behind = (0.0, 0.0)
        for t in range(n - 2, -1, -1):
            a, b = behind[0], behind[1] + content[t + 1]
            f = forward[t]
            for i in (0, 1):
                steps[i][0] += math.exp(f[i] + step[i][0] + a - whole)
                steps[i][1] += math.exp(f[i] + step[i][1] + b - whole)
            behind = (add(s00 + a, s01 + b), add(s10 + a, s11 + b))
            marginal[t] = math.exp(f[1] + behind[1] - whole)
        return marginal, steps

    def towards(self, lines: list[list[int]], target: tuple[list[float], list[list[float]]], rate: float) -> None:
        """One gradient step from the field's expectations to the target's."""
        marginal, steps = self.expected(self.scores(lines))
        pace = rate / math.sqrt(len(lines))
        for t, line in enumerate(lines):
            gap = target[0][t] - marginal[t]
            for k in line:
                self.weights[k] += pace * (gap - SHRINK * self.weights[k])
        self.begin[1] += pace * (target[0][0] - marginal[0])
        for i in (0, 1):
            for j in (0, 1):
                self.step[i][j] += pace * (target[1][i][j] - steps[i][j])

    def learn(self, lines: list[list[int]], states: list[int], rate: float) -> None:
        """One gradient step on the log-likelihood of lines whose states are known."""
        seen = [[0.0, 0.0], [0.0, 0.0]]
        for i, j in zip(states, states[1:]):
            seen[i][j] += 1
        self.towards(lines, ([float(s) for s in states], seen), rate)

    def tilted(self, lines: list[list[int]], good: bool) -> tuple[list[float], list[list[float]]]:
        """The posterior nearest to the field's that has the share of content which a good or bad document asks."""
        content = self.scores(lines)
        share, sign = (GOOD_SHARE, 1.0) if good else (BAD_SHARE, -1.0)
        enough = lambda found: sign * (sum(found[0]) / len(lines) - share) >= 0
        found = self.expected(content)
        if enough(found):
            return found
        low, high = 0.0, MOST_TILT
        for _ in range(TILTS):
            tilt = (low + high) / 2
            found = self.expected([e + sign * tilt for e in content])
            low, high = (low, tilt) if enough(found) else (tilt, high)
        return self.expected([e + sign * high for e in content])

    def learn_share(self, lines: list[list[int]], good: bool, rate: float) -> None:
        """One step of expectation-maximisation for a labelled document."""
        self.towards(lines, self.tilted(lines, good), rate)


def observe(line: bytes, repeated: bool) -> list[int]:
    """Numbers of the observations that hold for a line with a word."""
    n = len(line)
    signs = n - len(line.translate(None, SIGNS))
    upper = n - len(line.translate(None, UPPER))
    digits = n - len(line.translate(None, DIGITS))
    split = line.split()
    words = len(split)
    end = line[-1:]
    held = (
        True,
        signs * 12 > n,
        0 < signs * 12 <= n,
        upper * 2 > n,
        line.count(b"!!") * 4 > words,
        digits * 4 > n,
        line.count(b" | ") * 4 > words,
        b"</" in line or b"://" in line,
        repeated,
        end in (b".", b"?", b"!", b"\xbb", b'"'),
        words < 4,
        words > 12,
        words > 5 and 2 * len(set(split)) < words,
    )
    return [k for k, h in enumerate(held) if h]


def lines_of(text: bytes) -> tuple[list[list[int]], list[int], int]:
    """Observations and byte counts of the lines with a word, and how many of these repeat an earlier line."""
    seen: set[bytes] = set()
    found, sizes, repeats = [], [], 0
    for line in text.split(b"\n"):
        bare = line.strip(BLANK)
        if bare:
            again = line in seen
            repeats += again
            seen.add(line)
            found.append(observe(bare, again))
            sizes.append(len(bare))
    return found, sizes, repeats


def repeated_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text, its words and those inside three-word windows that occur in it twice or more."""
    w = words_of(texts, lower=False)
    n, owner = w.counts, w.owner()
    many = len(w.hash)
    if many < 3:
        return n, np.zeros(len(texts), np.int64)
    h = w.hash
    key = mix(mix(h[:-2] + np.uint64(1)) * np.uint64(3) + mix(h[1:-1] + np.uint64(2)) * np.uint64(5) + h[2:])
    key ^= mix(owner[:-2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7))
    at = np.flatnonzero(owner[:-2] == owner[2:])
    order = at[np.argsort(key[at], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(many, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return n, np.bincount(owner, covered, len(texts)).astype(np.int64)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(texts: list[bytes], chain: Chain) -> dict[str, list]:
    """All figures and the verdict for each text."""
    words, repeats = repeated_words(texts)
    out: dict[str, list] = {k: [] for k in (*MEASURES, "n_lines", "n_content_lines", "content_share", "base_failed", "kept")}
    for text, n, again in zip(texts, words.tolist(), repeats.tolist()):
        bare = text.translate(None, BLANK)
        chars = len(bare.decode("utf-8", "replace"))
        found, sizes, dup = lines_of(text)
        states = chain.decode(found)
        size = sum(sizes)
        share = sum(s for s, state in zip(sizes, states) if state) / size if size else 0.0
        failed = n < MIN_WORDS or 100 * again > REPEAT_PERCENT * n
        row = (n, chars, len(bare) - len(bare.translate(None, SIGNS)), dup, again, len(found), sum(states), share, failed, not failed and share >= CONTENT_SHARE)
        for k, value in zip(out, row):
            out[k].append(value)
    return out


def fit(docs: DataFrame, labels: DataFrame, bound: int = FIT_DOCUMENTS) -> Chain:
    """Weights from documents that ``labels`` calls good (quality 1) or bad (0).

    At most ``bound`` documents with at most ``FIT_LINES`` lines come to the driver. An id that is called both is left
    out. The weights are the mean over the steps of the last epoch."""
    chain = Chain.start()
    order = F.xxhash64(F.lit(9), "doc_id")
    marked = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("long").alias("quality")).dropna()
    single = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
    picked = single.select("doc_id", "quality").orderBy(order, "doc_id").limit(bound)
    short = docs.select("doc_id", "text").where(F.octet_length("text") <= FIT_BYTES)

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            lines = [lines_of(t)[0] for t in text_bytes(rows.column("text"))]
            held = pa.array([0 < len(found) <= FIT_LINES for found in lines])
            masks = pa.array([[sum(1 << k for k in line) for line in found] for found in lines], pa.list_(pa.int64()))
            columns = [rows.column("doc_id"), rows.column("quality"), masks]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "lines"]).filter(held)

    kind = docs.schema["doc_id"].dataType.simpleString()
    known = short.join(F.broadcast(picked), "doc_id").mapInArrow(features, f"doc_id {kind}, quality long, lines array<long>")
    # rows of one id become one where they are read
    one = known.groupBy("doc_id", "quality").agg(F.min("lines").alias("lines"))
    rows = one.select(order.alias("h"), "*").collect()
    bits = range(len(OBSERVATIONS))
    seen = [([[k for k in bits if m >> k & 1] for m in r["lines"]], r["quality"]) for r in sorted(rows, key=lambda r: (r["h"], r["lines"]))]
    if len({quality for _, quality in seen}) < 2:
        return chain
    total = Chain([0.0] * len(OBSERVATIONS), [[0.0, 0.0], [0.0, 0.0]], [0.0, 0.0])
    for epoch in range(EPOCHS):
        for lines, quality in seen:
            chain.learn_share(lines, quality == 1, RATE / (1 + epoch))
            if epoch == EPOCHS - 1:
                total.add(chain, 1 / len(seen))
    return total


def _rows(chain: Chain) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for a, z, texts in text_slices(rows.column("text"), BLOCK):
                found = measure(texts, chain)
                arrays = [rows.column("doc_id").slice(a, z - a)]
                arrays += [pa.array(v, pa.bool_() if k in ("base_failed", "kept") else pa.float64() if k == "content_share" else pa.int64()) for k, v in found.items()]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *found])

    return run


def quality_report(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, the five base figures, line counts, content_share, base_failed and kept, for every row."""
    figures = ", ".join(f"{k} long" for k in (*MEASURES, "n_lines", "n_content_lines"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {figures}, content_share double, base_failed boolean, kept boolean"
    return small_batches(docs.select("doc_id", "text")).mapInArrow(_rows(chain), schema)


def keep_good(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of ``docs``, all columns, whose document is kept."""
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            kept: list[bool] = []
            for _, _, texts in text_slices(rows.column(at), BLOCK):
                kept += measure(texts, chain)["kept"]
            yield rows.filter(pa.array(kept, pa.bool_()))

    return small_batches(docs).mapInArrow(run, docs.schema)
