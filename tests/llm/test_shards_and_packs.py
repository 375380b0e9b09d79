import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from rankloom.llm import packing
from rankloom.llm.common import text_slices
from rankloom.llm.packing import Packer, WordTokenizer, best_cuts, pack
from rankloom.llm.sharding import external_shuffle, shard_digest, write_shards
from tests.llm.edge import documents, empty, encoded, rows


def test_shards(spark):
    found = shard_digest(documents(spark)).collect()
    want = Counter((r[0], len(encoded(r[1])) + 8, zlib.crc32(encoded(r[1]))) for r in rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    slots: dict[int, list[int]] = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_shuffle_follows_seed_not_layout(spark):
    key = lambda df: sorted((r["record"]["doc_id"] or -1, r["record"]["text"] or "", r["shard"], r["slot"]) for r in df.collect())
    # of the rows that share doc_id and text, other columns decide
    one, two = (key(external_shuffle(documents(spark, n), bucket_bytes=4000)) for n in (2, 7))
    other = key(external_shuffle(documents(spark), bucket_bytes=4000, seed=9))
    assert one == two != other
    assert external_shuffle(empty(spark)).count() == 0


def test_written_shards(spark, tmp_path):
    write_shards(documents(spark), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows())
    assert Counter(r["shard"] for r in back.select("shard").collect()).keys() == {0, 1, 2, 3}


def test_packs(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    found = pack(documents(spark), path).collect()
    ids = Counter(tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (2,) for r in rows())
    pieces: dict[tuple, list] = {}
    for r in found:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] > 0
        pieces.setdefault((r["sequence_id"],), []).append((r["offset"], r["length"]))
    for group in pieces.values():
        at = 0
        for offset, length in sorted(group):
            assert offset == at
            at += length
        assert at <= 4096
    whole = Counter()
    by_doc: dict[tuple, list] = {}
    for r in found:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["sequence_id"], r["start"], r["ids"]))
    for (_, n), parts in by_doc.items():
        parts.sort()
        stream = [i for _, _, x in parts for i in x]
        for a in range(0, len(stream), n):  # rows that repeat an id follow each other
            whole[tuple(stream[a : a + n])] += 1
    assert whole == ids
    assert pack(empty(spark), path).count() == 0


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(0)
    for _ in range(30):
        bounds = np.unique(np.concatenate([[0], np.cumsum(rng.integers(1, 7, 14))]))
        cost, length = rng.integers(0, 9, len(bounds)).astype(float), 9

        def price(cuts):
            ends = [0, *cuts]
            return sum(length - (b - a) for a, b in zip(ends, ends[1:])) + sum(cost[list(bounds).index(c)] for c in cuts)

        best = {0: (0.0, [])}
        for j in range(1, len(bounds)):
            best[j] = min((best[i][0] + length - (bounds[j] - bounds[i]) + cost[j], [*best[i][1], int(bounds[j])]) for i in range(j) if bounds[j] - bounds[i] <= length)
        assert price(best_cuts(bounds, cost, length)) == best[len(bounds) - 1][0]


def test_open_window_is_carried():
    packer, total = Packer(16, 0, True), []
    rng = np.random.default_rng(3)
    for k in range(40):
        n = int(rng.integers(1, 30))
        packer.add(k, np.arange(n, dtype=np.uint32), np.arange(3, n, 4))
        if k % 5 == 4:
            total.append(packer.cut(k == 39))
    rows_of = {k: sum((t[k] for t in total), []) for k in total[0]}
    fill: dict[int, int] = Counter()
    seen: dict[int, int] = Counter()
    for d, s, n, q, o in zip(*(rows_of[k] for k in ("doc_id", "start", "length", "sequence_id", "offset"))):
        assert s == seen[d] and o == fill[q]
        seen[d] += n
        fill[q] += n
    assert set(seen) == set(range(40)) and max(fill.values()) <= 16


def test_long_texts_reach_python_in_small_batches(spark):
    """Memory of a task follows the bytes of a few rows, not of 10,000."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64m")
        docs = spark.range(3000, numPartitions=1).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), 1200) as text")
        assert pack(docs, with_ids=False).count() >= 3000

        def measured(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], names=["bytes"])

        assert max(r.bytes for r in docs.mapInArrow(measured, "bytes long").collect()) <= 9 << 20
        spark.conf.set(key, "1m")
        pack(docs)
        assert spark.conf.get(key).startswith(("1m", "1048576"))  # a tighter bound stays
    finally:
        spark.conf.set(key, before)
    texts = pa.array(["a" * 5, None, "b" * 9, "", "c" * 30, "d"])
    runs = list(text_slices(texts, 12))
    assert [x for _, _, part in runs for x in part] == [(t or "").encode() for t in texts.to_pylist()]
    assert all(len(part) == z - a and (len(part) == 1 or sum(map(len, part)) <= 12) for a, z, part in runs)


def test_words_are_encoded_and_remembered_in_parts(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [encoded(r[1]) for r in rows()]
    plain = Tokenizer.from_file(path)
    expected = [i for t in texts for i in plain.encode(t.decode(), add_special_tokens=False).ids]
    monkeypatch.setattr(packing, "ENCODED", 3)
    for most in (0, 20, 1 << 20):
        monkeypatch.setattr(packing, "REMEMBERED", most)
        tokenizer = WordTokenizer(path)
        assert [i for t in texts for i in tokenizer.block([t])[0].tolist()] == expected
        assert [i for a in range(0, len(texts), 4) for i in tokenizer.block(texts[a : a + 4])[0].tolist()] == expected
