"""Nested Markdown blocks, against a plain version that takes containers apart recursively."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions import blocks
from rankloom.functions.blocks import DEEPEST, NESTED, structure_of
from rankloom.operators import documents as D

TICKS = chr(96) * 3


def plain(lines):
    """(blocks, levels, unclosed) of lines without lazy texts, tabs and raw HTML: cut off the lines of a container, go on inside."""
    blocks, levels, unclosed, k, running = [], [], False, 0, False
    while k < len(lines):
        line = lines[k]
        body = line.lstrip(" ")
        free = len(line) - len(body)
        item = re.match(r"([-*+]|\d{1,9}[.)])( +)(?=\S)", body)
        if not body:
            running = False
            k += 1
        elif free > 3:
            k += 1
        elif body[0] == ">":
            inner = []
            while k < len(lines) and re.match(r" {0,3}>", lines[k]):
                inner.append(re.sub(r"^ {0,3}> ?", "", lines[k]))
                k += 1
            found = plain(inner)
            blocks, levels, unclosed, running = blocks + found[0], levels + found[1], unclosed or found[2], False
        elif fence := re.match(r"(`{3,})([^`]*)$|(~{3,})(.*)$", body):
            mark = fence[1] or fence[3]
            content, k, closed = [], k + 1, False
            while k < len(lines) and not closed:
                inner = lines[k].strip(" ")
                closed = len(inner) >= len(mark) and set(inner) == {mark[0]} and len(lines[k]) - len(lines[k].lstrip(" ")) <= 3
                if not closed:
                    content.append(re.sub(rf"^ {{0,{free}}}", "", lines[k]))
                k += 1
            if closed:
                blocks.append(((fence[2] if fence[1] else fence[4]) or "").strip() + "\n" + "".join(c + "\n" for c in content))
            unclosed, running = unclosed or not closed, False
        elif running and re.match(r"(=+|-+) *$", body):
            levels.append(1 if body[0] == "=" else 2)
            running = False
            k += 1
        elif atx := re.match(r"(#{1,6})( |$)", body):
            levels.append(len(atx[1]))
            running = False
            k += 1
        elif re.match(r"([-*_])( *\1){2,} *$", body):
            running = False
            k += 1
        elif item and not (running and item[1][-1] in ".)" and item[1][:-1] != "1"):
            gap = len(item[2])
            width = free + len(item[1]) + (gap if gap <= 4 else 1)
            inner = [line[width:]]
            k += 1
            while k < len(lines) and (not lines[k].strip() or lines[k].startswith(" " * width)):
                inner.append(lines[k][width:])
                k += 1
            found = plain(inner)
            blocks, levels, unclosed, running = blocks + found[0], levels + found[1], unclosed or found[2], False
        else:
            running = True
            k += 1
    return blocks, levels, unclosed


def piece(rng, depth):
    kind = rng.randrange(8 if depth else 6)
    if kind == 0:
        mark = rng.choice("`~") * rng.choice([3, 4])
        inside = [rng.choice(["x = 1", "# no heading", "", "  deeper", "- a", "> q", "~~" if mark[0] == "`" else "``"]) for _ in range(rng.randrange(4))]
        lead = " " * rng.choice([0, 0, 0, 1, 3])
        return [lead + mark + rng.choice(["", "py", " sh x"]), *(lead + x if x else x for x in inside), lead + mark]
    if kind == 1:
        return ["#" * rng.randint(1, 7) + rng.choice([" title", "tight", " a #", ""])]
    if kind == 2:
        return [rng.choice(["Title", "two words", "1986 began"]), rng.choice(["===", "---", "=", "-"])]
    if kind == 3:
        return ["some text", "more of it"][: rng.randint(1, 2)]
    if kind == 4:
        return ["    " + TICKS, "    shown", "    # shown"]
    if kind == 5:
        return [rng.choice(["***", "- - -", "___"])]
    inside = document(rng, depth - 1)
    if kind == 6:
        return [("> " + x).rstrip() if rng.random() < 0.9 or not x else ">" + x if x[0] != " " else "> " + x for x in inside]
    mark = rng.choice(["- ", "* ", "1. ", "-   ", "10) "])
    while inside and not inside[0]:
        inside = inside[1:]
    if not inside or inside[0].startswith(" "):
        inside = ["text", "", *inside]
    return [mark + inside[0], *((" " * len(mark) + x).rstrip() for x in inside[1:])]


def document(rng, depth):
    lines = []
    for _ in range(rng.randint(1, 4)):
        lines += piece(rng, depth) + [""]
    return lines[:-1]


def texts(depth, n):
    return ["\n".join(document(random.Random(seed), depth)) for seed in range(n)]


@pytest.mark.parametrize("depth", [0, 1, 2, 3])
def test_machine_equals_the_recursive_version(depth):
    nested = 0
    for text in texts(depth, 800):
        found = structure_of(text)
        assert (found["blocks"], found["headings"], found["unclosed"]) == plain(text.split("\n")), text
        nested += bool(found["blocks"])
    assert nested > 100


def test_patterns_do_for_the_others(spark):
    """Where the machine is not called, the linear patterns find what it would."""
    rows = [(t,) for depth in (0, 1, 2) for t in texts(depth, 400) if not plain(t.split("\n"))[2]]
    df = spark.createDataFrame(rows, "t STRING")
    linear = 0
    for row in D.markdown_structure(df.withColumn("flat", ~F.col("t").rlike(NESTED)), "t").collect():
        want = structure_of(row.t)
        assert (row.blocks, row.headings, row.unclosed) == (want["blocks"], want["headings"], want["unclosed"]), (row.flat, row.t)
        linear += row.flat
    assert linear > 50


CASES = [
    (f"- a\n\n  > {TICKS}sh\n  > run\n  > {TICKS}\n", ["sh\nrun\n"], [], False),
    (f"1. one\n   - two\n\n     {TICKS}\n     x\n       y\n     {TICKS}\n", ["\nx\n  y\n"], [], False),
    (f"    {TICKS}\n    shown, not open\n\ntext\n", [], [], False),
    (f"> {TICKS}\n> left open by the end of the quote\n\nafter\n", [], [], True),
    (f"- {TICKS}\n  x\n{TICKS}\ny\n{TICKS}\n", ["\ny\n"], [], True),
    ("> Quoted\n> ======\n>\n> ## Sub\n- # In an item\n", [], [1, 2, 1], False),
    ("> text\n===\n\nA\nB\n---\n", [], [2], False),
    ("- item\n---\n\n1. item\n---\n\n[a]: b\n---\n", [], [], False),
    ("<div>\n# raw\n\n# live\n</div>\n\n<!-- a\n\n# hidden\n-->\n## shown\n", [], [1, 2], False),
    ("<pre>\n\n# raw\n</pre>\n# live\n<b>\n\n# live\n", [], [1, 1], False),
    ("\t# code\n\n-\t# item\n\n- a\n\n\t## in it\n", [], [1, 2], False),
    ("-\n\n  # after an empty item\n", [], [1], False),
    (f"{TICKS}\r\na\r{TICKS}\r\n# b\r\n", ["\na\n"], [1], False),
    ("| a |\n---\n", [], [2], False),
    ("", [], [], False),
]


@pytest.mark.parametrize("text,blocks,headings,unclosed", CASES)
def test_case(spark, text, blocks, headings, unclosed):
    df = spark.createDataFrame([(text,)], "t STRING")
    row = D.markdown_structure(df, "t").first()
    assert (row.blocks, row.headings, row.unclosed) == (blocks, headings, unclosed)


def test_prose_has_no_code(spark):
    text = f"- see [guide](x.md) and `code`\n\n  {TICKS}\n  hidden\n  {TICKS}\n\n> quoted words\n\n    indented code\n"
    assert D.markdown_structure(spark.createDataFrame([(text,)], "t STRING"), "t").first().prose == "see guide and quoted words"


def test_changed_code_in_a_list_is_seen(spark):
    text = f"# T\n\n1. step\n\n   > {TICKS}sh\n   > echo original\n   > {TICKS}\n"
    pairs = [(text, text), (text.replace("original", "modified"), text), (text.replace("   > ", "   "), text), (text, text.rstrip(TICKS + "\n"))]
    df = spark.createDataFrame(pairs, "body STRING, source STRING").withColumn("mode", F.lit(P.MODE_TRANSLATION))
    found = [r.violations for r in D.structure_diff(df).collect()]
    assert found == [[], ["code_blocks"], [], ["unclosed_fence", "code_blocks"]]


def test_null_and_long_texts(spark):
    df = spark.createDataFrame([(None,)], "t STRING")
    assert D.markdown_structure(df, "t").first().blocks is None
    for text in ("> " * 50_000 + "# x", "- " * 50_000 + "x\n" + "> - " * 1000, ">\n" * 50_000, "<a " + " " * 100_000, "# " + " " * 100_000 + "x", "[" * 100_000):
        structure_of(text)
    assert structure_of("> " * (DEEPEST + 5) + "# x")["headings"] == []


def test_structures_of_few_texts_at_a_time(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64m")
        texts = [f"- # H{k}\n  text {k}" for k in range(7)] + ["plain"]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, md string").coalesce(1)
        D.markdown_structure(docs, "md").collect()
        assert int(spark.conf.get(key).rstrip("b")) <= 8 << 20  # long texts: few rows in a batch
    finally:
        spark.conf.set(key, before)
    held = []
    monkeypatch.setattr(blocks, "TOGETHER", 3)
    monkeypatch.setattr(blocks.pa, "array", lambda rows, kind, array=pa.array: held.append(len(rows)) or array(rows, kind))
    given = pa.chunked_array([[*texts, None]]).chunk(0)
    assert blocks._structures.func(given).to_pylist() == [structure_of(t) for t in texts] + [None]
    assert held and max(held) == 3
