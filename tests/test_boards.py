from datetime import date

import pytest
from fixtures import FRESH, entries, entry, full_matrix
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions import markup as M
from rankloom.functions import scalars as S
from rankloom.operators import boards as B

ROW = """<article class="pad Box-row wide"><h2 class="h3"><a data-x="1 > 0" href="/dock/{name}">dock /
 {name}</a></h2><p>aside</p><p class="col-9 text">Ropes <em>and</em> knots</p><b itemprop="programmingLanguage">Forth</b>
<a href="/dock/{name}/stargazers"><svg></svg> 9,041 </a><a href="/dock/{name}/forks">3.5k</a>
<span class="x float-sm-right">212 stars this week</span><span class="d-inline-block">By <img alt="@mo"><img alt=""><img alt="kai"></span></article>"""
BARE = '<article class="Box-row"><h2><a href="/dock/bare">bare</a></h2><p>only text</p></article>'
QUIET = "<body><h1>Trending today</h1><div>It looks like we don’t have any trending repositories for your choices.</div></body>"


def parsed(spark, *pages):
    return B.parse_boards(spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "page_id INT, html STRING"))


def spellings(row: str) -> list[str]:
    """The same row in other HTML: single quotes, upper case, bare attributes, references, comments between."""
    single = row.replace('"', "'")
    upper = row.replace("<article class", "<ARTICLE CLASS").replace("</article>", "</ARTICLE >").replace("<h2 class", "<H2 Class").replace("</h2>", "</H2>").replace("<a href", "<A HREF").replace("</a>", "</A>")
    bare = row.replace('href="/dock/knots"', "href=/dock/knots").replace('class="col-9 text"', "class=col-9").replace('itemprop="programmingLanguage"', "itemprop=programmingLanguage").replace('alt="kai"', "alt=kai")
    coded = row.replace("/dock/knots/forks", "/dock&#47;knots/forks").replace("Ropes", "R&#x6f;pes").replace("Forth", "&#70;orth")
    noted = row.replace("<p>aside</p>", '<!-- <article class="Box-row"> --><p>aside</p>')
    return [row, single, upper, bare, coded, noted]


def test_rows_in_any_spelling(spark):
    row = ROW.format(name="knots")
    for found in B.parsed_entries(parsed(spark, *spellings(row)), "page_id").collect():
        assert (found["rank"], found.full_name, found.url) == (1, "dock/knots", f"{P.SITE}/dock/knots"), found.page_id
        assert (found.total_stars, found.total_forks, found.period_stars) == (9041, 3500, 212), found.page_id
        assert (found.description, found.primary_language, found.built_by) == ("Ropes and knots", "Forth", ["mo", "kai"]), found.page_id


def test_a_page_keeps_all_of_its_rows(spark):
    pages = ["".join(spellings(ROW.format(name="knots"))) + BARE.replace('"', "'") + BARE]
    rows = B.parsed_entries(parsed(spark, *pages), "page_id").orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 9))
    last = rows[-1]
    assert (last.description, last.period_stars, last.primary_language, last.total_stars, last.built_by) == ("only text", None, None, 0, [])


def test_character_references(spark):
    cases = {"it&#8217;s caf&eacute;": "it’s café", "&amp;lt;": "&lt;", "&nope; &": "&nope; &", "&#x1F600;&#0;&lt;b&gt;": "\U0001f600&#0;<b>", "plain": "plain"}
    df = spark.createDataFrame([(k,) for k in cases], "t STRING")
    assert {r.t: r.u for r in df.select("t", M.unescape(F.col("t")).alias("u")).collect()} == cases


def test_page_outcomes(spark):
    pages = (
        ROW.format(name="a"),
        QUIET,
        "<title>Down for repairs</title><h1>Back soon</h1>",
        BARE + '<article class="Box-row"><h3>no heading link</h3><a href="/dock/x">x</a></article>',
        BARE.replace("/dock/bare", "/dock/bare/more"),
        QUIET.replace("Trending today", "Welcome"),
        BARE + '<article class="Box-row"><h2><a href="/dock/cut">cut',
    )
    rows = parsed(spark, *pages).orderBy("page_id").select("status", "error", F.size("entries")).collect()
    assert [tuple(r) for r in rows] == [
        ("success", None, 1),
        ("success", None, 0),
        ("failed", "unrecognized_page", 0),
        ("failed", "row_without_link", 0),
        ("failed", "invalid_row_key", 0),
        ("failed", "unrecognized_page", 0),
        ("failed", "unended_row", 0),
    ]


def test_page_numbers_of_many_scopes(spark):
    scopes = spark.range(1500).selectExpr("concat('s', id) as scope", "cast(id as int) as scope_no")
    assert B.board_matrix(scopes).select("page_no").distinct().count() == 1500 * len(P.PERIODS)


@pytest.mark.parametrize(
    "text,number",
    [("7,052,113 in all", 7052113), ("4.6k this week", 4600), ("no figure", 0), ("1.001k", int(1.001 * 1000)), ("2.5M", 2500000),
     ("12 kites", 12), ("1.9", 1), ("", 0), ("0.57k", int(0.57 * 1000)), ("1.0016k", int(1.0016 * 1000))],
)
def test_compact_numbers(spark, text, number):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.select(S.parse_compact_number(F.col("t"))).first()[0] == number


def test_matrix_has_every_page_once(spark):
    scopes = spark.createDataFrame([(s, i) for i, s in enumerate(P.SCOPES)], "scope STRING, scope_no INT")
    rows = B.board_matrix(scopes).orderBy("page_no").collect()
    assert len(rows) == len({(r.scope, r.period) for r in rows}) == 21
    assert [r.period for r in rows] == sorted((r.period for r in rows), key=P.PERIODS.index)
    assert rows[0].url == f"{P.SITE}/trending?since=daily&spoken_language_code="
    assert rows[1].slug == "python-daily" and "/trending/python?" in rows[1].url


def test_consolidation_keeps_first_seen_and_all_appearances(spark):
    day = date(2026, 8, 27)
    rows = [
        entry(day, "python", "daily", 4, "a/b", 5, page_no=1, description="later", total_stars=9),
        entry(day, "global", "daily", 7, "a/b", None, page_no=0, description="first", primary_language=None, total_stars=3),
        entry(day, "go", "weekly", 1, "a/b", 8, page_no=2, status="failed", total_stars=99),
    ]
    (item,) = B.consolidate(entries(spark, rows)).collect()
    assert (item.description, item.primary_language, item.total_stars) == ("first", None, 9)
    assert item.appearance_count == 2
    seen = B.appearances(entries(spark, rows)).orderBy("page_no").collect()
    assert [(a.scope, a["rank"], a.period_stars) for a in seen] == [("global", 7, None), ("python", 4, 5)]


def test_measures_of_a_full_matrix(spark):
    day = date(2026, 8, 27)
    rows = {r.full_name: r for r in B.candidate_measures(entries(spark, full_matrix(day))).collect()}
    new = rows[FRESH]
    assert (new.average_rank, new.appearance_count, new.daily_stars, new.monthly_stars) == (1.0, 21, 132, 1430)


def test_boards_from_events_match_a_plain_count(spark):
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    events = [(start + timedelta(hours=5 * i), ("x", "y")[i % 2], i % 7 if i % 3 else 0, i * 13 % 101) for i in range(150)]
    df = spark.createDataFrame(events, "ts TIMESTAMP, scope STRING, item BIGINT, metric BIGINT")
    capture = date(2024, 1, 25)
    got = {
        (r.scope, r.period, r.rank): (r["item"], r.metric) for r in B.board_rows(df, [capture], top=3).collect()
    }
    want = {}
    for period, days in P.PERIOD_DAYS.items():
        for scope in ("global", "x", "y"):
            totals = {}
            for ts, kind, item, metric in events:
                if scope in ("global", kind) and 0 <= (capture - ts.date()).days < days:
                    totals[item] = totals.get(item, 0) + metric
            for rank, (item, metric) in enumerate(sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:3], 1):
                want[scope, period, rank] = (item, metric)
    assert got == want
