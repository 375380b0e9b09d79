"""Packing token streams into fixed windows by order-preserving dynamic programming.

Documents keep their order. Their tokens form one stream, which is cut into windows of at most ``length``
tokens; the cuts minimise padding plus a penalty for each cut that truncates: none at the end of a
document, ``SENTENCE_COST`` at the end of a sentence, ``WORD_COST`` inside one. With boundaries b_0 < b_1 < ...
the least cost is

    f(j) = length - b_j + penalty(j) + min(f(i) + b_i  for i with b_j - b_i <= length),

a minimum over a sliding window, kept in a monotone queue: linear time.

Each task packs the documents of its partition, a segment of ``SEGMENT`` tokens at a time; the last window of
a segment stays open and begins the next, so a task leaves one short window at its end. That one is
cut at powers of two, which need no padding. Nothing is shuffled, and memory is one segment, whatever
the length of a document.

Null texts are empty; an empty text has the end token alone. Repeated rows are packed as often as they
occur; a null doc_id is kept. The order of documents is that of the table.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rankloom.llm.common import text_slices
from rankloom.llm.words import SPACE, segment_hash
from rankloom.session import small_batches

LENGTH = 4096
END = 2
SENTENCE_COST, WORD_COST = 4.0, 24.0
#: Tokens packed at a time, and bytes of text tokenized at a time.
SEGMENT, BLOCK = 1 << 19, 1 << 19
#: A boundary inside a sentence is offered when a stretch without one is this long.
STRIDE = 32
#: Words a worker remembers; beyond them it starts anew.
REMEMBERED = 1_000_000
#: Word parts given to the tokenizer at a time: it keeps far more for each than its ids.
ENCODED = 1 << 13

_PLAIN = np.full(256, 3, np.uint8)  # 0 space, 1 letter, 2 sign, 3 to be tokenized with all of its word
_PLAIN[SPACE] = 0
_PLAIN[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = 2
_PLAIN[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


class WordTokenizer:
    """Token ids of whole blocks of texts, each distinct word part tokenized once.

    The tokenizer drops white space and never joins across it, and splits runs of letters from runs of
    signs; so words of ASCII and Latin-1 letters and ASCII signs are cut into such runs, and each run
    gives the ids it has in the text. Words with anything else (digits, apostrophes, other scripts, the
    start of a special token) are tokenized whole."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ends = [token.endswith("</w>") for token in map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))]
        self.word_end = np.array(ends, bool)
        self.forget()

    def forget(self) -> None:
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # of the known parts, by key
        self.ids = np.zeros(0, np.uint32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encode(self, plain: list[str], whole: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and id counts of the plain parts, then of the whole words."""
        done = [self._encode_some(plain[i : i + ENCODED], []) for i in range(0, len(plain), ENCODED)]
        done += [self._encode_some([], whole[i : i + ENCODED]) for i in range(0, len(whole), ENCODED)]
        return np.concatenate([ids for ids, _ in done]), np.concatenate([sizes for _, sizes in done])

    def _encode_some(self, plain: list[str], whole: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat: list[int] = []
        for e in self.tokenizer.encode_batch([" ".join(plain[i : i + 500]) for i in range(0, len(plain), 500)], add_special_tokens=False):
            flat += e.ids
        ids = np.array(flat, np.uint32)
        closes = np.flatnonzero(self.word_end[ids]) + 1 if len(ids) else np.zeros(0, np.int64)
        if len(closes) != len(plain):  # the vocabulary marks word ends otherwise than assumed
            plain, whole, ids, closes = [], plain + whole, np.zeros(0, np.uint32), np.zeros(0, np.int64)
        each = [e.ids for e in self.tokenizer.encode_batch(whole, add_special_tokens=False)]
        sizes = np.concatenate([np.diff(closes, prepend=0), np.array([len(x) for x in each], np.int64)])
        return np.concatenate([ids, np.array([i for x in each for i in x], np.uint32)]), sizes.astype(np.int64)

    def parts(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each part, and whether it is plain."""
        kind = _PLAIN[data]
        lead = data == 0xC3
        follows = np.zeros(len(data), bool)
        follows[1:] = lead[:-1]
        letter = follows & (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
        kind[letter] = 1
        kind[:-1][lead[:-1] & letter[1:]] = 1
        special = np.zeros(len(data), bool)
        special[:-1] = (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        kind[special] = 3
        space = kind == 0
        before = np.concatenate([[True], space[:-1]])
        word = np.flatnonzero(before & ~space)
        if not len(word):
            return word, word, np.zeros(0, bool)
        hard = np.maximum.reduceat(kind[word[0] :], word - word[0]) == 3  # a word's segment reaches into white space, which is 0
        close = np.flatnonzero(space & ~before)
        change = np.zeros(len(data), bool)
        change[1:] = (kind[1:] != kind[:-1]) & ~space[1:] & ~space[:-1]
        inner = np.flatnonzero(change)
        inner = inner[~hard[np.searchsorted(word, inner, "right") - 1]]
        start = np.sort(np.concatenate([word, inner]))
        owner = np.searchsorted(word, start, "right") - 1
        end = np.minimum(np.append(start[1:], len(data)), close[owner])
        return start, end, ~hard[owner]

    def block(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the end of each text among them, and the ends of sentences."""
        raw = b"\n".join(texts) + b"\n"
        data = np.frombuffer(raw, np.uint8)
        start, end, plain = self.parts(data)
        folded = np.frombuffer(raw.lower(), np.uint8)
        key = segment_hash(np.where(SPACE[data], data, folded), start)
        key = np.where(plain, key, segment_hash(data, start) ^ np.uint64(1))
        distinct, at, back = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self.forget()
        place = np.searchsorted(self.keys, distinct)
        number = np.full(len(distinct), -1, np.int64)
        known = np.flatnonzero(place < len(self.keys))
        known = known[self.keys[place[known]] == distinct[known]]
        number[known] = self.numbers[place[known]]
        new = np.flatnonzero(number < 0)
        if len(new):
            first, last, is_plain = start[at[new]], end[at[new]], plain[at[new]]
            order = np.argsort(~is_plain, kind="stable")
            text = [raw[a:b].decode("utf-8", "replace") for a, b in zip(first[order].tolist(), last[order].tolist())]
            cut = int(is_plain.sum())
            ids, sizes = self._encode(text[:cut], text[cut:])
            offset = len(self.starts)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, ids])
            number[new[order]] = offset + np.arange(len(new))
            self.keys = np.insert(self.keys, place[new], distinct[new])
            self.numbers = np.insert(self.numbers, place[new], number[new])
        of = number[back]
        sizes = self.sizes[of]
        after = np.cumsum(sizes)
        total = int(after[-1]) if len(after) else 0
        source = np.repeat(self.starts[of] - (after - sizes), sizes) + np.arange(total)
        ids = self.ids[source]
        limits = np.cumsum([len(t) + 1 for t in texts])
        done = np.searchsorted(start, limits)
        text_end = np.concatenate([[0], after])[done]
        return ids, text_end, after[_STOP[data[np.maximum(end - 1, 0)]]] if len(end) else after


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer_at(path: str) -> WordTokenizer:
    """One tokenizer for a worker; tasks that it runs later use what it remembers."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def best_cuts(bounds: np.ndarray, cost: np.ndarray, length: int) -> list[int]:
    """Ends of the windows of least cost. ``bounds`` ascend from the first token's place to the end; no gap
    exceeds ``length``; ``cost`` is the penalty for a cut at each."""
    b, c = bounds.tolist(), cost.tolist()
    total, back = [0.0] * len(b), [0] * len(b)
    queue: deque[tuple[float, int]] = deque([(float(b[0]), 0)])
    for j in range(1, len(b)):
        while b[j] - b[queue[0][1]] > length:
            queue.popleft()
        least, i = queue[0]
        total[j], back[j] = least + length - b[j] + c[j], i
        value = total[j] + b[j]
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [], len(b) - 1
    while j:
        cuts.append(b[j])
        j = back[j]
    return cuts[::-1]


def with_strides(ends: np.ndarray, total: int, stride: int) -> np.ndarray:
    """Boundaries added so that no two neighbours are further apart than ``stride``."""
    edges = np.unique(np.concatenate([[0], ends, [total]]))
    gaps = np.diff(edges)
    wide = np.flatnonzero(gaps > stride)
    if len(wide):
        edges = np.unique(np.concatenate([edges, *[np.arange(edges[k], edges[k + 1], stride) for k in wide]]))
    return edges


class Packer:
    """Packs documents as they come; ``sequence`` is the next free number."""

    def __init__(self, length: int, sequence: int, with_ids: bool):
        self.length, self.sequence, self.with_ids = length, sequence, with_ids
        self.docs: list[tuple[object, int, int]] = []  # doc_id, its ids in all, of which are already packed
        self.ids, self.stops = [], []
        self.size = 0

    def add(self, doc_id, ids: np.ndarray, stops: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids), 0))
        self.ids.append(ids)
        self.stops.append(self.size + stops)
        self.size += len(ids)

    def cut(self, last: bool) -> dict[str, list]:
        """Rows of all windows but the open one, or of all."""
        rows: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
        if not self.size:
            return rows
        ids, stops = np.concatenate(self.ids), np.concatenate(self.stops)
        doc_end = np.cumsum([n - used for _, n, used in self.docs])
        bounds = with_strides(np.concatenate([stops, doc_end]), self.size, min(STRIDE, self.length))
        cost = np.full(len(bounds), WORD_COST)
        cost[np.isin(bounds, stops, kind="sort")] = SENTENCE_COST
        cost[np.isin(bounds, doc_end, kind="sort")] = 0.0
        cuts = best_cuts(bounds, cost, self.length)
        if last:
            begin, tail = (cuts[-2] if len(cuts) > 1 else 0), cuts.pop()
            while begin < tail:
                begin += min(self.length, 1 << ((tail - begin).bit_length() - 1))
                cuts.append(begin)
        else:
            cuts.pop()
        window_end = np.array(cuts, np.int64)
        done = int(window_end[-1]) if cuts else 0
        doc_begin = np.concatenate([[0], doc_end[:-1]])
        edges = np.unique(np.concatenate([doc_end[doc_end <= done], window_end]))
        begins = np.concatenate([[0], edges[:-1]]).astype(np.int64) if len(edges) else edges
        doc = np.searchsorted(doc_end, begins, "right")
        window = np.searchsorted(window_end, begins, "right")
        window_begin = np.concatenate([[0], window_end[:-1]]) if cuts else window_end
        packed = ids.astype("<u4")
        for a, z, d, w in zip(begins.tolist(), edges.tolist(), doc.tolist(), window.tolist()):
            doc_id, n, used = self.docs[d]
            rows["doc_id"].append(doc_id)
            rows["start"].append(used + a - int(doc_begin[d]))
            rows["length"].append(z - a)
            rows["ids_crc32"].append(zlib.crc32(packed[a:z].tobytes()))
            rows["doc_tokens"].append(n)
            rows["sequence_id"].append(self.sequence + w)
            rows["offset"].append(a - int(window_begin[w]))
            if self.with_ids:
                rows["ids"].append(packed[a:z].astype(np.int32))
        self.sequence += len(cuts)
        keep = int(np.searchsorted(doc_end, done, "right"))
        rest = self.docs[keep:]
        if rest:
            doc_id, n, used = rest[0]
            rest[0] = (doc_id, n, used + done - int(doc_begin[keep]))
        self.docs, self.ids, self.stops = rest, [ids[done:]], [stops[stops > done] - done]
        self.size -= done
        return rows


SCHEMA = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(path: str, length: int, with_ids: bool, key_type: pa.DataType):
    fields = [("doc_id", key_type), *[(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def batch(rows: dict[str, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(length, TaskContext.get().partitionId() << 33, with_ids)
        tokenizer = tokenizer_at(path)
        for rows in batches:
            keys = rows.column(0).to_pylist()
            for a, _, texts in text_slices(rows.column(1), BLOCK):
                ids, ends, stops = tokenizer.block(texts)
                begin = 0
                for k, end in enumerate(ends.tolist()):
                    own = stops[np.searchsorted(stops, begin, "right") : np.searchsorted(stops, end, "right")] - begin
                    packer.add(keys[a + k], np.append(ids[begin:end], np.uint32(END)), own)
                    begin = end
                    if packer.size >= SEGMENT:
                        yield batch(packer.cut(False))
        yield batch(packer.cut(True))

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for.

    ``tokenizer`` is the path of the vocabulary file, the same on all machines (by default, that of the public
    one). Columns of ``docs`` other than doc_id and text are not read."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    from pyspark.sql.pandas.types import to_arrow_type

    rows = small_batches(docs.select("doc_id", "text"))
    kind = rows.schema["doc_id"].dataType
    schema = SCHEMA.format(kind.simpleString()) + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(_pack(tokenizer, length, with_ids, to_arrow_type(kind)), schema)
