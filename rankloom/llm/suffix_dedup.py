"""Removal of long repeated substrings by blockwise suffix sorting with a cover sample.

Every byte that lies in a ``SPAN``-byte string which also starts earlier (in a smaller document, or earlier in
the same one) is removed. All suffixes are compared to the depth ``SPAN``, one bucket of suffixes at a time:

* The cover sample. Each window of ``SPAN`` bytes has an anchor, the start of its least ``GRAM``-byte gram (by hash,
  the leftmost on ties). About one place in 35 is an anchor. Where two windows are equal, their anchors lie at the same
  distance, so the anchors serve as the sample of a difference cover: any two suffixes that could tie
  reach sample places at one common shift. (A cover of fixed residues has to ship 14 percent of all
  places, about 2 bytes per byte of text; the anchors take 3 percent.)
* Buckets. A suffix belongs to the bucket of its anchor's gram. Grams that occur once in all documents cannot
  hold a repeat; they are counted and left out. A run of suffixes with one anchor travels as one record: its bytes.
* Ranks. In a bucket, the sample places are sorted once by what follows them and once by what precedes them
  (lexicographic order with the lengths of common prefixes). The suffixes at shift d from their anchors are then
  ordered by two ranks, that of the ``SPAN - d`` bytes from the anchor on and that of the d bytes before it, however long
  the tie is; no text is compared again. Suffixes with both ranks equal are equal strings; all but the earliest
  are repeats.

Documents are dealt to groups of about ``GROUP_BYTES`` and buckets take about ``BUCKET_BYTES``; both counts grow with
the table. Equal records of one group are sent once. A gram with more than ``HOT`` records is cut into its single
suffixes, each bucketed by its own ``SPAN`` bytes, so that no gram, line or passage makes a large bucket.

Null text: empty. Texts shorter than ``SPAN`` lose nothing. Of rows with one doc_id, those with the smaller
text hash count as earlier; a null doc_id comes before all others. Other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import bucket_of, parts, text_bytes, total_bytes
from rankloom.llm.words import mix

SPAN, GRAM = 100, 32
REACH = SPAN - GRAM  #: an anchor lies at most so far behind a window's start
GROUP_BYTES, BUCKET_BYTES = 4 << 20, 24 << 20
HOT = 20_000
PIECE = 1 << 16
NULL_DOC = -(1 << 63)

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
RECORD = np.dtype([("doc", "<i8"), ("tie", "<i8"), ("row", "<u4"), ("start", "<u4"), ("lead", "u1"), ("run", "u1")])
REPEAT = np.dtype([("row", "<u4"), ("start", "<u4"), ("run", "<u4")])
KNOWN = np.dtype([("gram", "<u8"), ("hot", "u1")])


def _grams(words: np.ndarray, at) -> np.ndarray:
    """Hash of the 32 bytes from each place; ``words`` are the 8 bytes from each place."""
    x = words[at] * _C[0]
    for k in (1, 2, 3):
        x ^= x >> np.uint64(29)
        x += words[at + 8 * k] if isinstance(at, np.ndarray) else words[at.start + 8 * k : at.stop + 8 * k]
        x *= _C[k]
    return x ^ (x >> np.uint64(32))


class Group:
    """The documents of one group in order, and their suffix runs."""

    def __init__(self, table: pa.Table):
        docs = [NULL_DOC if d is None else d for d in table.column("doc_id").to_pylist()]
        ties = table.column("tie").to_pylist()
        texts = text_bytes(table.column("text"))
        self.order = sorted(range(len(docs)), key=lambda k: (docs[k], ties[k]))
        self.doc = np.array([docs[k] for k in self.order], np.int64)
        self.tie = np.array([ties[k] for k in self.order], np.int64)
        self.texts = [texts[k] for k in self.order]
        size = np.array([len(t) for t in self.texts], np.int64)
        self.end = np.cumsum(size)
        self.begin = self.end - size
        self.total = int(size.sum())
        self.raw = b"".join(self.texts) + bytes(SPAN + 64)
        self._runs()

    def _runs(self) -> None:
        """Runs of windows with one anchor: start, length, anchor, gram."""
        n = self.total
        self.words = np.ndarray((n + SPAN + 48,), "<u8", self.raw, strides=(1,))
        within = np.zeros(n + 1, np.int8)
        long = self.end - self.begin >= SPAN
        np.add.at(within, self.begin[long], 1)
        np.add.at(within, self.end[long] - SPAN + 1, -1)
        valid = np.cumsum(within[:-1], dtype=np.int8).astype(bool)
        anchor = np.full(n, -1, np.int64)
        place = np.arange(PIECE + REACH, dtype=np.uint64)
        low = np.uint64((1 << 17) - 1)
        for a in range(0, n, PIECE):
            z = min(a + PIECE, n)
            if not valid[a:z].any():
                continue
            m = z - a + REACH
            least = (_grams(self.words, slice(a, a + m)) & ~low) | place[:m]
            width = 1
            while 2 * width <= REACH + 1:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            rest = REACH + 1 - width
            if rest:
                least = np.minimum(least[:-rest], least[rest:])
            anchor[a:z] = (least[: z - a] & low).astype(np.int64) + a
        anchor[~valid] = -1
        edge = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1 if n else np.zeros(0, np.int64)
        start = np.concatenate([[0], edge]).astype(np.int64)[: n or 0]
        stop = np.append(edge, n)[: len(start)]
        held = anchor[start] >= 0
        self.start, self.run = start[held], (stop - start)[held]
        self.anchor = anchor[self.start]
        self.gram = _grams(self.words, self.anchor) if len(self.anchor) else np.zeros(0, np.uint64)
        self.row = np.searchsorted(self.end, self.start, "right")

    def split(self, known: list[bytes]) -> tuple[list[tuple], list[tuple[int, int]]]:
        """Records to sort, (start, run, lead, sort key), and windows known here to repeat, (start, run).

        ``known`` lists the grams that repeat. A record's bytes are sent once; later equal ones repeat."""
        table = np.concatenate([np.frombuffer(k, KNOWN) for k in known]) if known else np.zeros(0, KNOWN)
        table = table[np.argsort(table["gram"], kind="stable")]
        at = np.minimum(np.searchsorted(table["gram"], self.gram), max(len(table) - 1, 0))
        hit = table["gram"][at] == self.gram if len(table) else np.zeros(len(self.gram), bool)
        seen: set[bytes] = set()
        single: set[bytes] = set()
        send, again, raw = [], [], self.raw
        picked = np.flatnonzero(hit)
        lead = (self.anchor - self.start)[picked]
        hot = table["hot"][at[picked]] if len(table) else lead
        for s, n, d, g, is_hot in zip(self.start[picked].tolist(), self.run[picked].tolist(), lead.tolist(), self.gram[picked].tolist(), hot.tolist()):
            body = raw[s : s + n + SPAN - 1]
            if body in seen:  # equal bytes have equal anchors
                again.append((s, n))
                continue
            seen.add(body)
            if not is_hot:
                send.append((s, n, d, g))
                continue
            for p in range(s, s + n):
                own = raw[p : p + SPAN]
                if own in single:
                    again.append((p, 1))
                else:
                    single.add(own)
                    send.append((p, 1, 0, -1))
        return send, again


def _count(groups: int):
    """A group's distinct grams with their counts, by bucket of grams."""

    def run(table: pa.Table) -> pa.Table:
        own = Group(table)
        gram, count = np.unique(own.gram, return_counts=True)
        bucket = (gram >> np.uint64(20)) % np.uint64(groups)
        order = np.argsort(bucket, kind="stable")
        gram, count, bucket = gram[order], count[order], bucket[order].astype(np.int64)
        distinct, first = np.unique(bucket, return_index=True)
        edges = np.append(first, len(bucket))
        grams = [gram[a:z].tobytes() for a, z in zip(edges, edges[1:])]
        counts = [count[a:z].astype("<u4").tobytes() for a, z in zip(edges, edges[1:])]
        g = table.column("g")[0].as_py()
        return pa.table({"bucket": pa.array(distinct, pa.int64()), "g": pa.array([g] * len(distinct), pa.int64()), "grams": pa.array(grams, pa.binary()), "counts": pa.array(counts, pa.binary())})

    return run


def _repeating(hot: int):
    """Of a bucket of grams, for each group those that occur twice or more in all groups."""

    def run(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
        gram = np.concatenate(rows)
        count = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()]).astype(np.int64)
        distinct, back = np.unique(gram, return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, back, count)
        groups, lists, at = [], [], 0
        for g, own in zip(table.column("g").to_pylist(), rows):
            sums = total[back[at : at + len(own)]]
            at += len(own)
            held = sums > 1
            if held.any():
                found = np.zeros(int(held.sum()), KNOWN)
                found["gram"], found["hot"] = own[held], sums[held] > hot
                groups.append(g)
                lists.append(found.tobytes())
        return pa.table({"g": pa.array(groups, pa.int64()), "kind": pa.array([0] * len(groups), pa.int32()), "data": pa.array(lists, pa.binary())})

    return run


def _records(buckets: int):
    """A group's records with repeating grams, by bucket of suffixes."""

    def run(table: pa.Table, lists: pa.Table) -> pa.Table:
        empty = pa.table({"bucket": pa.array([], pa.int64()), "g": pa.array([], pa.int64()), "records": pa.array([], pa.binary()), "bodies": pa.array([], pa.binary())})
        if not len(table) or not len(lists):
            return empty
        own = Group(table)
        send, _ = own.split(lists.column("data").to_pylist())
        if not send:
            return empty
        start = np.array([s for s, _, _, _ in send], np.int64)
        row = np.searchsorted(own.end, start, "right")
        records = np.zeros(len(send), RECORD)
        records["doc"], records["tie"], records["row"] = own.doc[row], own.tie[row], row
        records["start"] = start - own.begin[row]
        records["run"], records["lead"] = [n for _, n, _, _ in send], [d for _, _, d, _ in send]
        key = np.array([g if g >= 0 else 0 for *_, g in send], np.uint64)
        alone = np.flatnonzero([g < 0 for *_, g in send])
        if len(alone):  # a single suffix goes by all of its bytes
            h = _grams(own.words, start[alone])
            for shift in (32, 64, SPAN - 32):
                h = mix(h + _grams(own.words, start[alone] + shift))
            key[alone] = h
        bucket = ((key >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        distinct, first = np.unique(bucket[order], return_index=True)
        edges = np.append(first, len(order))
        heads, bodies = [], []
        for a, z in zip(edges, edges[1:]):
            mine = order[a:z]
            heads.append(records[mine].tobytes())
            bodies.append(b"".join([own.raw[s : s + n + SPAN - 1] for s, n in ((send[k][0], send[k][1]) for k in mine.tolist())]))
        g = table.column("g")[0].as_py()
        return pa.table({"bucket": pa.array(distinct, pa.int64()), "g": pa.array([g] * len(distinct), pa.int64()), "records": pa.array(heads, pa.binary()), "bodies": pa.array(bodies, pa.binary())})

    return run


def _ranked(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lexicographic order of the rows of a byte matrix, and the common prefix with the row before in it."""
    n, width = columns.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = columns
    keys = padded.view(">u8").astype(np.uint64)
    order = np.lexsort(tuple(keys[:, k] for k in range(keys.shape[1] - 1, -1, -1)))
    common = np.zeros(n, np.int64)
    for a in range(1, n, PIECE):
        z = min(a + PIECE, n)
        differ = columns[order[a:z]] != columns[order[a - 1 : z - 1]]
        common[a:z] = np.where(differ.any(1), differ.argmax(1), width)
    return order, common


def repeats(records: np.ndarray, bodies: bytes, group: np.ndarray) -> np.ndarray:
    """Of one bucket, for each record the windows (by shift) that also start earlier."""
    n = len(records)
    size = records["run"].astype(np.int64) + SPAN - 1
    first = np.cumsum(size) - size
    order = np.lexsort((records["start"].astype(np.int64) + records["lead"], records["row"], group, records["tie"], records["doc"]))
    matrix = np.zeros((n, REACH + SPAN), np.uint8)
    flat = np.frombuffer(bodies, np.uint8)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    begin = place * (REACH + SPAN) + REACH - records["lead"].astype(np.int64)
    cells = matrix.ravel()
    for a in range(0, n, PIECE // 4):
        z = min(a + PIECE // 4, n)
        low, high = first[a], first[z - 1] + size[z - 1]
        to = np.repeat(begin[a:z] - (first[a:z] - low), size[a:z]) + np.arange(high - low)
        cells[to] = flat[low:high]
    lead = records["lead"][order].astype(np.int64)
    last = lead - records["run"][order] + 1
    after_order, after = _ranked(matrix[:, REACH:])
    before_order, before = _ranked(np.ascontiguousarray(matrix[:, REACH - 1 :: -1] if REACH else matrix[:, :0]))
    found = np.zeros((n, REACH + 1), bool)
    rank = np.empty(n, np.int64)
    for shift in range(REACH + 1):
        at = np.flatnonzero((last <= shift) & (shift <= lead))
        if len(at) < 2:
            continue
        rank[after_order] = np.cumsum(after < SPAN - shift)
        key = rank[at] * (n + 1)
        rank[before_order] = np.cumsum(before < shift)
        key += rank[at]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        found[at[by[1:][same]], shift] = True
    result = np.empty_like(found)
    result[order] = found
    return result


def _sorted_bucket(table: pa.Table) -> pa.Table:
    """One bucket of suffixes: for each group the windows that repeat."""
    heads = [np.frombuffer(x, RECORD) for x in table.column("records").to_pylist()]
    group = np.repeat(table.column("g").to_numpy(), [len(h) for h in heads])
    records = np.concatenate(heads)
    found = repeats(records, b"".join(table.column("bodies").to_pylist()), group)
    # windows ascend as shifts descend
    flipped = np.zeros((len(records), REACH + 3), np.int8)
    flipped[:, 1:-1] = found[:, ::-1]
    step = np.diff(flipped, axis=1)
    row, begin = np.nonzero(step == 1)
    _, end = np.nonzero(step == -1)
    out = np.zeros(len(row), REPEAT)
    out["row"] = records["row"][row]
    out["start"] = records["start"][row].astype(np.int64) + records["lead"][row] - (REACH - begin)
    out["run"] = end - begin
    owner = group[row]
    order = np.argsort(owner, kind="stable")
    distinct, first = np.unique(owner[order], return_index=True)
    edges = np.append(first, len(order))
    data = [out[order[a:z]].tobytes() for a, z in zip(edges, edges[1:])]
    return pa.table({"g": pa.array(distinct, pa.int64()), "kind": pa.array([1] * len(distinct), pa.int32()), "data": pa.array(data, pa.binary())})


def _removed(with_text: bool):
    """A group's documents without the bytes that repeated windows cover."""

    def run(table: pa.Table, lists: pa.Table) -> pa.Table:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
        own = Group(table) if len(table) else None
        rows: list[list] = [[] for _ in names]
        if own:
            kind, data = lists.column("kind").to_pylist(), lists.column("data").to_pylist()
            mark = np.zeros(own.total + 1, np.int32)

            def cover(start: np.ndarray, n: np.ndarray) -> None:
                np.add.at(mark, start, 1)
                np.add.at(mark, start + n + SPAN - 1, -1)

            _, again = own.split([d for k, d in zip(kind, data) if k == 0])
            if again:
                cover(np.array([s for s, _ in again], np.int64), np.array([n for _, n in again], np.int64))
            for d in (d for k, d in zip(kind, data) if k == 1):
                found = np.frombuffer(d, REPEAT)
                cover(own.begin[found["row"]] + found["start"], found["run"].astype(np.int64))
            gone = np.cumsum(mark[:-1]) > 0
            source = table.column("doc_id").to_pylist()
            for k, (text, a, z) in enumerate(zip(own.texts, own.begin.tolist(), own.end.tolist())):
                mask = gone[a:z]
                lost = int(mask.sum())
                kept = np.frombuffer(text, np.uint8)[~mask].tobytes() if lost else text
                spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if lost else 0
                row = (source[own.order[k]], z - a, lost, spans, sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if with_text else None)
                for column, value in zip(rows, row):
                    column.append(value)
        types = [table.schema.field("doc_id").type, *[pa.int64()] * 3, pa.string(), pa.string()]
        out = pa.table([pa.array(r, t) for r, t in zip(rows, types)], names=names)
        if not with_text:
            return out.drop_columns(["kept_text"])
        order = pa.array(own.order if own else [], pa.int64())
        return out.append_column("record", table.column("record").take(order))

    return run


def suffix_dedup(docs: DataFrame, with_text: bool = True, group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row; with ``with_text`` also kept_text and the
    other columns of ``docs`` as struct ``record``.

    ``kept_sha256`` is of the remaining bytes; ``kept_text`` is these bytes as text, without characters that a cut
    left in part."""
    total = total_bytes(docs)
    groups, grams, buckets = parts(total, group_bytes), parts(total, 2 * bucket_bytes), parts(total, bucket_bytes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] if with_text else []
    carried = [F.struct(F.lit(None).cast("int").alias("_"), *others).alias("record")] if with_text else []
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"), *carried)
    dealt = keyed.withColumn("g", bucket_of(2, groups, "doc_id", "tie").cast("long"))
    by_group = dealt.groupBy("g")
    counts = by_group.applyInArrow(_count(grams), "bucket long, g long, grams binary, counts binary")
    known = counts.groupBy("bucket").applyInArrow(_repeating(hot), "g long, kind int, data binary")
    records = by_group.cogroup(known.groupBy("g")).applyInArrow(_records(buckets), "bucket long, g long, records binary, bodies binary")
    found = records.groupBy("bucket").applyInArrow(_sorted_bucket, "g long, kind int, data binary")
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        schema += f", kept_text string, record {dealt.schema['record'].dataType.simpleString()}"
    return by_group.cogroup(known.unionByName(found).groupBy("g")).applyInArrow(_removed(with_text), schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, texts without their repeats; ``n_chars``, if there, follows the text."""
    done = suffix_dedup(docs)
    own = {"doc_id": F.col("doc_id"), "text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
    return done.select(*[own.get(c, F.col(f"record.`{c}`")).alias(c) for c in docs.columns])
