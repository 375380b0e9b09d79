import hashlib

import pytest
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions import text as X
from rankloom.operators import documents as D
from rankloom.operators import links as L

TICKS = chr(96) * 3
BODY = f"""# 潮汐表

## 查表步骤

先在港口名单里找到最近的测站，再按日期读出高潮与低潮的时刻；水位以海图基准面为零点，单位是厘米。
遇到大风或者暴雨，实际水位会偏离表中数值，出海以前请再看一次当天的通告，并且留出足够的余量和时间。

1. 选择测站

   {TICKS}sh
   tides --station north
   {TICKS}
"""


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def declared(name, raw, document, mode):
    """The manifest row of a document that states its source and itself truly."""
    key = name.replace("/", "__")
    return {
        "full_name": name, "source_url": f"{P.SITE}/{name}/blob/main/README.md", "source_sha256": sha(raw),
        "source_artifact": f"readmes/sources/{sha(raw)}.md", "source_bytes": len(raw.encode()), "mode": mode,
        "translation": f"readmes/{key}.zh-CN.md", "translation_sha256": sha(document),
        "translation_bytes": len(document.split("---\n", 2)[-1].strip().encode()),
    }


def tables(spark, count=1, mode=P.MODE_COPY, source=BODY, change=lambda d: d, entry=lambda e: e, drop_source=False, own_body=False):
    """(manifest, files, sources); ``change`` edits a document before its hash is declared."""
    rows, texts = [], {}
    for i in range(count):
        raw = f"{source}\n第{i}站\n" if own_body else source
        head = {"full_name": f"port/tide{i}", "source_url": f"{P.SITE}/port/tide{i}/blob/main/README.md", "source_sha256": sha(raw), "language": "zh-CN", "mode": mode}
        document = change("---\n" + "".join(f"{k}: {v}\n" for k, v in head.items()) + "---\n\n" + raw)
        true = declared(head["full_name"], raw, document, mode)
        rows.append((entry(true), (true["translation"], document)))
        texts[true["source_artifact"]] = raw
    pair = "path STRING, text STRING"
    kinds = {"source_bytes": "INT", "translation_bytes": "INT"}
    schema = ", ".join(f"{k} {kinds.get(k, 'STRING')}" for k in declared("a/b", "", "---\n---\n", mode))
    return (
        spark.createDataFrame([m for m, _ in rows], schema),
        spark.createDataFrame([f for _, f in rows], pair),
        spark.createDataFrame([] if drop_source else list(texts.items()), pair),
    )


def found(spark, **options):
    rows = D.localized_validation(*tables(spark, **options)).collect()
    return [r.violations for r in sorted(rows, key=lambda r: r.full_name)]


def test_valid_documents(spark):
    assert found(spark) == [[]]
    assert found(spark, mode=P.MODE_TRANSLATION) == [[]]
    assert found(spark, count=2, own_body=True) == [[], []]


@pytest.mark.parametrize(
    "options,rules",
    [
        ({"drop_source": True}, ["source_missing"]),
        ({"entry": lambda e: {**e, "source_bytes": 1}}, ["source_bytes"]),
        ({"entry": lambda e: {**e, "translation_sha256": "0"}}, ["translation_sha256"]),
        ({"entry": lambda e: {**e, "translation": "x.md"}}, ["translation_path"]),
        ({"entry": lambda e: {**e, "translation_bytes": 1}}, ["translation_bytes"]),
        ({"change": lambda d: d.replace("language: zh-CN", "language: en")}, ["language"]),
        ({"change": lambda d: d.replace("mode: source-copy\n", "")}, ["frontmatter"]),
        ({"change": lambda d: d + "\nmore"}, ["copy_differs"]),
        ({"mode": P.MODE_TRANSLATION, "change": lambda d: d.replace("--station north", "--station south")}, ["code_blocks"]),
        ({"mode": P.MODE_TRANSLATION, "change": lambda d: d.replace("## 查表步骤", "查表步骤")}, ["headings"]),
        ({"mode": P.MODE_TRANSLATION, "change": lambda d: d + "\n待翻译"}, ["placeholder"]),
        ({"mode": P.MODE_TRANSLATION, "change": lambda d: d + "\n" + "long foreign words " * 10}, ["foreign_passage"]),
        ({"source": "# Title\n\nonly foreign words in here"}, ["copy_not_native"]),
    ],
)
def test_document_rule(spark, options, rules):
    assert found(spark, **options) == [rules]


def test_same_body_under_two_names(spark):
    assert found(spark, count=2) == [["repeated_body"], ["repeated_body"]]


def test_a_translation_may_add_one_title(spark):
    pairs = spark.createDataFrame(
        [("# T\n\n# A\n\n## B", "# A\n\n## B"), ("## T\n\n# A", "# A")], "body STRING, source STRING"
    ).withColumn("mode", F.lit(P.MODE_TRANSLATION))
    assert [r.violations for r in D.structure_diff(pairs).collect()] == [[], ["headings"]]


def structure(spark, text):
    return D.markdown_structure(spark.createDataFrame([(text,)], "t STRING"), "t").first()


def test_structure(spark):
    text = (
        f"Title\n=====\n\n## Two ##\n\n{TICKS}py x\n# not a heading\n{TICKS}\n\n~~~\n{TICKS}\n~~~\n\n"
        f"> {TICKS}\n> quoted\n> {TICKS}\n\nSub\n---\n\n####### seven\n#tag\n"
    )
    row = structure(spark, text)
    assert row.headings == [1, 2, 2]
    assert row.blocks == ["py x\n# not a heading\n", f"\n{TICKS}\n", "\nquoted\n"]
    assert not row.unclosed
    assert structure(spark, f"a\n{TICKS}\nb\n").unclosed
    assert structure(spark, f"a\n{TICKS}{TICKS[:1]}\nb\n{TICKS}\n").unclosed  # the closing fence is too short


def test_frontmatter(spark):
    text = "---\r\nfull_name: a/b\r\nsource_url: https://x/y:z\r\nnoise\r\nfull_name: c/d\r\n---\r\n\r\n body \r\n"
    df = spark.createDataFrame([(text,), ("no header",)], "t STRING").withColumn("e", X.frontmatter_entries(F.col("t")))
    value = lambda k: X.frontmatter_value(F.col("e"), k)
    first, second = df.select(
        value("full_name"), value("source_url"), X.frontmatter_complete(F.col("e")), X.frontmatter_body(F.col("t"))
    ).collect()
    assert tuple(first) == ("c/d", "https://x/y:z", False, "body")
    assert tuple(second) == (None, None, False, "no header")


def test_script_count_skips_code_and_links(spark):
    text = f"中文<!-- 注释 -->{TICKS}\n代码\n{TICKS} https://x/路径 data:文,a 末"
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.select(X.script_chars(F.col("t"))).first()[0] == 3


GUIDE = """# Tide tables

Start at [the basin](harbor/basin.md?level=2#gates), then see ![buoy](<charts/north buoy.svg> "Buoy") and
[![plan](charts/plan.png)](harbor/plan.md 'Plan'), or go [up](../../up.md) and [home](/index.md).
Leave [elsewhere](https://tides.example/x), [here](#gates), [mail](mailto:a@tides.example) and [none]() alone.

<IMG SRC='charts/mark.gif'> <a href="logs/2024 may.txt">log</a>

![Pilot][] ![wide view][sheet] [chart list][list]

[pilot]: charts/pilot.webp
[sheet]: <charts/sheet one.webp> "Sheet"
   [list]: logs/list.txt
"""


def test_links_of_a_guide(spark):
    df = spark.createDataFrame([(GUIDE, "port/tides", "next/1", "guide/README.md")], "md STRING, full_name STRING, branch STRING, doc_path STRING")
    raw, blob = f"{P.RAW_SITE}/port/tides/next%2F1/", f"{P.SITE}/port/tides/blob/next%2F1/"
    got = {(r.syntax, r.target): (r.image, r.absolute) for r in L.absolutize_links(df, "md").collect()}
    assert got == {
        ("inline", "harbor/basin.md?level=2#gates"): (False, blob + "guide/harbor/basin.md?level=2#gates"),
        ("inline", "charts/north buoy.svg"): (True, raw + "guide/charts/north%20buoy.svg"),
        ("inline", "charts/plan.png"): (True, raw + "guide/charts/plan.png"),
        ("inline", "harbor/plan.md"): (False, blob + "guide/harbor/plan.md"),
        ("inline", "../../up.md"): (False, blob + "up.md"),
        ("inline", "/index.md"): (False, blob + "/index.md"),
        ("inline", "https://tides.example/x"): (False, "https://tides.example/x"),
        ("inline", "#gates"): (False, "#gates"),
        ("inline", "mailto:a@tides.example"): (False, "mailto:a@tides.example"),
        ("html", "charts/mark.gif"): (True, raw + "guide/charts/mark.gif"),
        ("html", "logs/2024 may.txt"): (False, blob + "guide/logs/2024%20may.txt"),
        ("reference", "charts/pilot.webp"): (True, raw + "guide/charts/pilot.webp"),
        ("reference", "charts/sheet one.webp"): (True, raw + "guide/charts/sheet%20one.webp"),
        ("reference", "logs/list.txt"): (False, blob + "guide/logs/list.txt"),
    }
    text = L.absolutize_text(df, "md").first().md
    expected = GUIDE
    for old, new in (
        ("(harbor/basin.md", f"({blob}guide/harbor/basin.md"),
        ("<charts/north buoy.svg>", f"<{raw}guide/charts/north%20buoy.svg>"),
        ("(charts/plan.png)", f"({raw}guide/charts/plan.png)"),
        ("(harbor/plan.md", f"({blob}guide/harbor/plan.md"),
        ("(../../up.md)", f"({blob}up.md)"),
        ("(/index.md)", f"({blob}/index.md)"),
        ("'charts/mark.gif'", f"'{raw}guide/charts/mark.gif'"),
        ('"logs/2024 may.txt"', f'"{blob}guide/logs/2024%20may.txt"'),
        (": charts/pilot.webp", f": {raw}guide/charts/pilot.webp"),
        ("<charts/sheet one.webp>", f"<{raw}guide/charts/sheet%20one.webp>"),
        (": logs/list.txt", f": {blob}guide/logs/list.txt"),
    ):
        assert expected.count(old) == 1
        expected = expected.replace(old, new)
    assert text == expected


def test_media_of_a_text(spark):
    text = "<video src=a></video> `<table>` <Details>x</Details> ![p](q) <b>no</b>"
    df = spark.createDataFrame([(text,)], "md STRING")
    assert df.select(X.media_tags(F.col("md"))).first()[0] == ["details", "img", "video"]


def test_targets_above_the_root(spark):
    df = spark.createDataFrame([("[a](../../x/.b.md)", "o/p", "main", "README.md")], "md STRING, full_name STRING, branch STRING, doc_path STRING")
    assert L.absolutize_links(df, "md").first().absolute == f"{P.SITE}/o/p/blob/main/x/.b.md"


def test_sections(spark):
    text = "## A\n\nfirst\n\nsecond\n\n## A+B (x)\nthird\n## C"
    df = spark.createDataFrame([(text,)], "t STRING")
    cols = [X.section(F.col("t"), h) for h in ("A", "A+B (x)", "C", "D")]
    assert tuple(df.select(*cols).first()) == ("first\n\nsecond", "third", "", "")
    assert df.select(X.first_paragraph(cols[0])).first()[0] == "first"


def test_broken_links(spark):
    pages = spark.createDataFrame(
        [
            ("index.html", '<a class=x href="repos/a.html">a</a><link href="style.css"><script>"<a href=\'no.html\'>"</script>'),
            ("repos/a.html", '<a href="../index.html#x">i</a> <a href=\'b%20c.html?q\'>b</a> <a href="#y">y</a><a href="mailto:x">m</a><a href="../repos/">d</a><a href="/index.html">r</a><!-- <a href="z.html"> -->'),
            ("repos/b c.html", '<a href="HTTPS://x.org">x</a><a href="../../out.html">o</a><a href="?q=1">q</a>'),
        ],
        "path STRING, html STRING",
    )
    got = {(r.page, r.href) for r in L.broken_links(pages, pages).collect()}
    assert got == {("index.html", "style.css"), ("repos/a.html", "/index.html"), ("repos/b c.html", "../../out.html")}


def test_outline(spark):
    df = spark.createDataFrame([(1, '<h2 id="a">A <b>x</b></h2><h2>no id</h2><h3 id="c">c</h3><h2 class="k" id="b">B</h2>')], "k INT, html STRING")
    assert [(r.position, r.heading_id, r.heading) for r in L.page_outline(df, "k", "html").collect()] == [(1, "a", "A x"), (2, "b", "B")]


def test_outlines_and_links_in_any_spelling(spark):
    html = "<H2 class='k' ID=one>A</H2><h2 id='two &amp; 2'>B <b>b</b></h2><!-- <h2 id=no>x</h2> --><h2>none</h2><h2 data-id='z'>n</h2><h2 id = \"three\">C</h2 >"
    df = spark.createDataFrame([(1, html)], "k INT, html STRING")
    assert [(r.heading_id, r.heading) for r in L.page_outline(df, "k", "html").collect()] == [("one", "A"), ("two & 2", "B b"), ("three", "C")]
    links = "<A HREF=a.html>a</A><a class=x href='b.html'>b</a><a data-href=no.html>n</a><link rel=s href = c.css><a href=d.html/>d</a><a title='x > y' href=e.html?q=1&amp;r>e</a>"
    found = spark.createDataFrame([(links,)], "html STRING").select(L.hrefs(F.col("html"))).first()[0]
    assert found == ["a.html", "b.html", "c.css", "d.html/", "e.html?q=1&r"]


def test_a_very_long_document(spark):
    lines = "word another line of text, with ordinary marks\n" * 40000
    text = f"# T\n\n{TICKS}\n{lines}{TICKS}\n\n{lines}\n<!-- {lines} -->\n[a](b.md)\n"
    df = spark.createDataFrame([(text,)], "t STRING")
    row = D.markdown_structure(df, "t").first()
    assert row.headings == [1] and row.blocks == ["\n" + lines] and not row.unclosed
    pair = df.select(F.col("t").alias("body"), F.col("t").alias("source"), F.lit(P.MODE_TRANSLATION).alias("mode"))
    assert D.structure_diff(pair).first().violations == []
    assert df.select(X.has_foreign_passage(F.col("t")), X.script_chars(F.col("t"))).first()[0] is True
    linked = df.select("t", F.lit("o/p").alias("full_name"), F.lit("main").alias("branch"), F.lit("README.md").alias("doc_path"))
    assert L.absolutize_text(linked, "t").first().t.endswith(f"[a]({P.SITE}/o/p/blob/main/b.md)\n")


def collection(spark, count=2, entry_count=None, version=1, displayed=None, catalog=None, files=lambda f: f, manifest=lambda m: m, **options):
    m, f, s = tables(spark, count=count, own_body=True, **options)
    names = [(f"port/tide{i}",) for i in range(count)]
    frame = lambda rows: spark.createDataFrame(rows, "full_name STRING")
    header = spark.createDataFrame([(version, count if entry_count is None else entry_count)], "schema_version INT, entry_count INT")
    rows = D.localized_collection(header, manifest(m), files(f), s, frame(names if displayed is None else displayed), frame(names if catalog is None else catalog))
    return sorted((r.check, r["item"], *r.violations) for r in rows.collect())


def test_a_sound_collection_has_no_findings(spark):
    assert collection(spark) == []


STRAY = [("readmes/stray.zh-CN.md", "x")]
FIRST = "readmes/port__tide0.zh-CN.md"


@pytest.mark.parametrize(
    "options,findings",
    [
        ({"entry_count": 3, "version": 2}, [("manifest", "entry_count", "entry_count"), ("manifest", "schema_version", "schema_version")]),
        ({"entry_count": 4, "manifest": lambda m: m.unionByName(m)}, [("body", None, "repeated_body")] * 2 + [("name", f"port/tide{i}", "repeated_name") for i in (0, 1)]),
        ({"displayed": [("port/tide1",), ("port/new",)]}, [("name", "port/new", "entry_missing", "not_in_catalog"), ("name", "port/tide0", "not_displayed")]),
        ({"catalog": [("port/tide0",), ("port/other",)]}, [("name", "port/tide1", "not_in_catalog")]),
        ({"files": lambda f: f.unionByName(f.sparkSession.createDataFrame(STRAY, f.schema))}, [("file", STRAY[0][0], "file_extra")]),
        ({"files": lambda f: f.where(F.col("path") != FIRST)}, [("document", "port/tide0", "file_missing"), ("file", FIRST, "file_missing")]),
        ({"entry": lambda e: {**e, "source_bytes": 1}}, [("document", f"port/tide{i}", "source_bytes") for i in (0, 1)]),
    ],
)
def test_findings_of_a_collection(spark, options, findings):
    found = [(c, None if c == "body" else i, *rules) for c, i, *rules in collection(spark, **options)]
    assert sorted(found, key=repr) == sorted(findings, key=repr)


def test_single_spaces_and_ranges_are_not_gone_over(spark):
    """The cheaper patterns find what the plain ones find."""
    texts = ["", " ", "  ", "a b", "a  b \n c\t", "\n a", "\t", "a\x0b\x0c b   c d\r\n", " x \n", "é   b"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(X.one_space(F.col("t"))).collect()] == [r[0] for r in rows.select(F.regexp_replace("t", r"\s+", " ")).collect()]
    assert X.each_char("A-Ca0-2\\-–") == "ABCa012\\-–"
