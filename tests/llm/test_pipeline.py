"""The pipeline over the smallest tables: each stage against a plain version, on what the stage before it kept."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from rankloom.llm.common import read
from rankloom.llm.quality_rules import BLANK, CONTENT_SHARE, fit, lines_of
from tests.llm.edge import encoded
from tests.llm.test_duplicates import plain_classes


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """[(name, input rows, output rows)], each stage written and read again."""
    docs, out = read(spark, folder, "documents"), []
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, folder).write.parquet(path)
        done = spark.read.parquet(path)
        out.append((name, docs.collect(), done.collect(), docs.columns, done.columns))
        docs = done
    return {name: rest for name, *rest in out}


def test_names_and_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "near_duplicates", "suffix_dedup", "decontamination", "packing"]
    for name, (_, after, given, made) in stages.items():
        assert after and (name == "packing" or made == given)


def best_path(chain, lines):
    """The most likely states, by the plain recursion."""
    content = chain.scores(lines)
    paths = {s: (chain.begin[s] + content[0] * s, [s]) for s in (0, 1)}
    for e in content[1:]:
        paths = {s: max(((v + chain.step[p][s] + e * s, [*path, s]) for p, (v, path) in paths.items()), key=lambda x: x[0]) for s in (0, 1)}
    return max(paths.values(), key=lambda x: x[0])[1]


def test_quality_rules(spark, folder, stages):
    before, after, *_ = stages["quality_rules"]
    chain = fit(read(spark, folder, "documents"), read(spark, folder, "labels"))
    kept = set()
    for r in before:
        words = encoded(r.text).split()
        windows: dict = {}
        for i in range(len(words) - 2):
            windows.setdefault(tuple(words[i : i + 3]), []).append(i)
        again = len({j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 3)})
        lines, sizes, _ = lines_of(encoded(r.text))
        if len(words) >= 50 and 100 * again <= 50 * len(words):
            assert sum(sizes) == sum(len(x.strip(BLANK)) for x in encoded(r.text).split(b"\n"))
            if sum(n for n, s in zip(sizes, best_path(chain, lines)) if s) >= CONTENT_SHARE * sum(sizes):
                kept.add(r.doc_id)
    assert {r.doc_id for r in after} == kept and 0 < len(kept) < len(before)


def test_near_duplicates(stages):
    before, after, *_ = stages["near_duplicates"]
    classes = plain_classes([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted({root for _, root in classes.values()})


def test_suffix_dedup(stages):
    before, after, *_ = stages["suffix_dedup"]
    texts = {r.doc_id: r.text for r in after}
    seen = set()
    for r in sorted(before, key=lambda r: r.doc_id):
        data = encoded(r.text)
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        pieces = re.findall(rb"\0+", bytes(gone)) and bytes(c for c, g in zip(data, gone) if not g)
        assert texts[r.doc_id] == (pieces or b"").decode("utf-8", "ignore")
    assert len(after) == len(before) and all(r.n_chars == len(r.text) for r in after)


def test_decontamination(spark, folder, stages):
    before, after, *_ = stages["decontamination"]
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    items = [words(r.text) for r in read(spark, folder, "benchmark").collect()]
    whole = {" ".join(w) for w in items if len(w) >= 13}
    runs = {tuple(w[i : i + 4]) for w in items for i in range(len(w) - 3)}
    kept = {r.doc_id for r in after}
    for r in before:
        w = words(r.text)
        text = " ".join(w)
        if any(p in text for p in whole):
            assert r.doc_id not in kept
        if not any(tuple(w[i : i + 4]) in runs for i in range(len(w) - 3)):
            assert r.doc_id in kept
    assert 0 < len(kept) <= len(before)


def test_packing(stages):
    before, after, *_ = stages["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces: dict = {}
    fill: dict = {}
    for r in after:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["ids"]))
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for r in before:
        assert [i for _, ids in sorted(pieces.pop(r.doc_id)) for i in ids] == [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
    assert not pieces
    for group in fill.values():
        at = 0
        for offset, length in sorted(group):
            assert offset == at
            at += length
        assert at <= 4096


def test_run_gives_the_last_stage(spark, folder, stages):
    found = pipeline.run(spark, folder)
    assert found.select(F.sum("length")).first()[0] == sum(r["length"] for r in stages["packing"][1])
    assert pipeline.ORACLE_SQL is None
