"""Views over the warehouse tables that give every operator its input.

Rows keep the tables' own keys and grow with the tables. Variations (missing values, broken
hashes, dropped headings, …) follow from the keys, so that each rule has rows on both sides.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions.scalars import canonical_url
from rankloom.operators.boards import board_rows, page_number
from rankloom.operators.catalog import CATALOG_SCHEMA, catalog_upsert
from rankloom.operators.edition import period_features
from rankloom.operators.ranking import evaluate, trend_board, trend_boards
from rankloom.session import stored
from rankloom.sources.tables import read_table, spread

#: Days between the two captures.
BETWEEN = 7
TOP = 25
EVENT_SCOPES = ("click", "error", "purchase", "signup", "view")
SCOPES = ("global",) + EVENT_SCOPES
KINDS = {"click": "/click", "purchase": "/purchase", "signup": "/signup", "view": "/view"}
SCRIPT = "à-ÿÀ-Ÿ"


def when_mod(key: Column, modulus: int, rest: int, then, otherwise) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.when(key % modulus == rest, lit(then)).otherwise(lit(otherwise))


def item_name(item: Column, kind: str = "item") -> Column:
    return F.concat(F.lit("org"), (item % 7).cast("string"), F.lit(f"/{kind}"), item.cast("string"))


_CAPTURES: dict[tuple[str, str], date] = {}


def capture(spark: SparkSession, folder: str) -> date:
    """The newest day of the events: the date of the capture, read once a session for each folder of tables. Tables without
    events have the first day of 1970."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _CAPTURES:
        newest = spark.read.parquet(f"{folder}/events.parquet").select(F.max("ts").cast("date").alias("day")).first()["day"]
        _CAPTURES[key] = newest or date(1970, 1, 1)
    return _CAPTURES[key]


def prior(spark: SparkSession, folder: str) -> date:
    """The capture before."""
    return capture(spark, folder) - timedelta(days=BETWEEN)


def board_events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select(
        "ts",
        F.col("event_type").alias("scope"),
        F.col("user_id").alias("item"),
        F.round(F.col("value") * 100).cast("bigint").alias("metric"),
    )


def scopes(spark: SparkSession, folder: str) -> DataFrame:
    """Scopes found in the data, with ``global`` and a number in name order."""
    types = read_table(spark, folder, "events").select("event_type").distinct()
    found = types.select(F.explode(F.array(F.col("event_type"), F.lit("global"))).alias("scope"))
    return found.distinct().withColumn("scope_no", scope_number())


def scope_number() -> Column:
    """The known scopes in their order; any other has a number from its hash, above them."""
    place = F.array_position(F.array(*map(F.lit, SCOPES)), F.col("scope")) - 1
    hashed = F.lit(len(SCOPES)) + F.pmod(F.xxhash64("scope"), F.lit((1 << 39) - len(SCOPES)))
    return F.when(place >= 0, place).otherwise(hashed)


def board_entries(spark: SparkSession, folder: str) -> DataFrame:
    last = capture(spark, folder)
    rows = board_rows(board_events(spark, folder), [last - timedelta(days=BETWEEN), last], TOP)
    return as_entries(rows)


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The boards as a dated table, for plans that read them more than once."""
    return stored(board_entries(spark, folder), "snapshots", "capture_date")


def as_entries(rows: DataFrame) -> DataFrame:
    period_no = F.array_position(F.array(*map(F.lit, P.PERIODS)), F.col("period")) - 1
    name = item_name(F.col("item"))
    source = F.concat(F.lit(P.SITE + P.BOARD_PATH + "/"), "scope", F.lit("?since="), "period")
    return rows.select(
        "capture_date",
        page_number(period_no, scope_number()).alias("page_no"),
        "scope",
        "period",
        F.lit("any").alias("spoken_language"),
        source.alias("source_url"),
        F.concat(F.col("capture_date").cast("string"), F.lit("T09:00:00+08:00")).alias("captured_at"),
        F.sha2(F.concat(source, F.col("capture_date").cast("string")), 256).alias("raw_sha256"),
        F.when((F.col("scope") == "error") & (F.col("period") == "daily"), "failed").otherwise("success").alias("status"),
        "rank",
        "item",
        name.alias("full_name"),
        canonical_url(name).alias("url"),
        F.concat(name, F.lit(" in "), "scope", F.lit(" "), "period").alias("description"),
        F.when(F.col("scope") != "global", F.col("scope")).alias("primary_language"),
        (F.col("metric") * 3 + F.col("rank")).alias("total_stars"),
        F.col("hits").alias("total_forks"),
        F.when(F.col("metric") % 7 != 0, F.col("metric")).alias("period_stars"),
        F.array(F.concat(F.lit("u"), F.col("item").cast("string"))).alias("built_by"),
    )


def board_pages(entries: DataFrame) -> DataFrame:
    return entries.select(
        "capture_date", "page_no", "scope", "period", "source_url", "captured_at", "raw_sha256", "status"
    ).distinct()


def altered_entries(entries: DataFrame) -> DataFrame:
    """Entries with broken values, for the page rules."""
    k = F.col("item")
    return (
        entries.withColumn("rank", when_mod(k, 11, 3, 0, F.col("rank")))
        .withColumn("url", when_mod(k, 13, 5, F.concat(F.lit("http://mirror/"), "full_name"), F.col("url")))
        .withColumn("period_stars", when_mod(k, 17, 2, -1, F.col("period_stars")))
        .withColumn("raw_sha256", F.when(F.col("scope") == "click", F.substring("raw_sha256", 1, 60)).otherwise(F.col("raw_sha256")))
        .withColumn("captured_at", F.when(F.col("scope") == "view", F.lit("yesterday")).otherwise(F.col("captured_at")))
        .withColumn("built_by", F.when(k % 19 != 4, F.col("built_by")))
    )


def components(k: Column, limits: dict[str, int], step: int, over: bool) -> Column:
    pairs = []
    for i, (name, limit) in enumerate(limits.items()):
        value = F.lit(limit) - (k * (i + step)) % (limit // 2 + 1)
        if over and i == 0:
            value = when_mod(k, 47, 7, limit + 1, value)
        pairs += [F.lit(name), value.cast("int")]
    return F.create_map(*pairs)


def enrichment(spark: SparkSession, folder: str) -> DataFrame:
    """One enrichment record per customer that has events."""
    active = read_table(spark, folder, "events").select(F.col("user_id").alias("c_custkey")).distinct()
    # nation is a fixed list of countries; Spark sizes it and picks the join
    customers = (
        read_table(spark, folder, "customer")
        .join(active, "c_custkey", "left_semi")
        .join(read_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )
    k = F.col("c_custkey")
    name = item_name(k)
    url = canonical_url(name)
    day = F.date_sub(F.lit(date(2024, 1, 20)), ((k * 7) % 180).cast("int")).cast("string")
    created = (
        F.when(k % 3 == 0, F.concat(day, F.lit("T00:30:00Z")))
        .when(k % 3 == 1, F.concat(day, F.lit("T00:30:00+08:00")))
        .otherwise(F.concat(day, F.lit("T10:00:00")))
    )
    quality, value = components(k, P.QUALITY_LIMITS, 5, True), components(k, P.VALUE_LIMITS, 3, False)
    total = lambda scores: F.aggregate(F.map_values(scores), F.lit(0), lambda a, v: a + v)
    gates = [x for i, g in enumerate(P.GATES) for x in (F.lit(g), k % (29 + 2 * i) != 5)]
    none = F.array().cast("array<string>")
    return customers.select(
        k.alias("item"),
        name.alias("full_name"),
        when_mod(k, 73, 11, F.concat(F.lit("http://mirror/"), name), url).alias("url"),
        F.concat(F.lit("Item "), k.cast("string")).alias("description"),
        when_mod(k, 61, 1, "", F.col("c_mktsegment")).alias("category"),
        created.alias("created_at"),
        when_mod(k, 53, 9, "not-a-time", "2024-01-29T00:00:00Z").alias("pushed_at"),
        (k % 17 == 3).alias("is_fork"),
        (k % 19 == 4).alias("is_mirror"),
        (k % 23 == 6).alias("archived"),
        F.when(k % 10 != 3, F.col("n_name")).alias("language"),
        F.create_map(*gates).alias("hard_filter"),
        F.struct(
            when_mod(k, 59, 2, "", F.concat(F.lit("L"), (k % 4).cast("string"))).alias("name"),
            when_mod(k, 43, 8, "plain", "usage à tous").alias("scope_zh"),
            F.array(F.concat(url, F.lit("/blob/main/LICENSE"))).alias("evidence_urls"),
        ).alias("license"),
        F.struct(
            quality.alias("scores"),
            (total(quality) + when_mod(k, 31, 0, 1, 0)).alias("total"),
            when_mod(k, 37, 0, "", F.concat(F.lit("static evidence "), k.cast("string"))).alias("rationale"),
            when_mod(k, 67, 5, none, F.array(F.concat(url, F.lit("/src")), url)).alias("evidence_urls"),
        ).alias("quality"),
        F.struct(
            value.alias("scores"),
            total(value).alias("total"),
            when_mod(k, 41, 0, "P9", F.concat(F.lit("P"), (k % 5).cast("string"))).alias("level"),
            F.lit("reusable").alias("rationale"),
            when_mod(k, 71, 3, F.array(F.lit("http://mirror/x")), F.array(url)).alias("evidence_urls"),
        ).alias("value"),
        F.struct(F.concat(F.lit("Résumé "), k.cast("string")).alias("one_line")).alias("card"),
        F.array(url, F.concat(url, F.lit("/README.md"))).alias("evidence_urls"),
    )


def empty_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CATALOG_SCHEMA)


def earlier_enrichment(rows: DataFrame) -> DataFrame:
    """Enrichment as of the earlier capture, when some keys did not pass a gate yet."""
    early = F.transform_values(
        "hard_filter", lambda gate, passed: passed & ((gate != "readme_clear") | (F.col("item") % 3 != 1))
    )
    return rows.withColumn("hard_filter", early)


class Batch:
    """The two captures: boards and evaluations as dated tables, and what follows from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.entries = snapshots(spark, folder)
        self.pages = board_pages(self.entries)
        self.enrichment = enrichment(spark, folder)
        self.day = capture(spark, folder)
        self.before = self.day - timedelta(days=BETWEEN)
        self.trend = trend_board(self.entries, self.day)
        self._evaluations: DataFrame | None = None

    @property
    def evaluations(self) -> DataFrame:
        if self._evaluations is None:
            on = lambda rows, day: rows.withColumn("capture_date", F.lit(day))
            records = on(self.enrichment, self.day).unionByName(on(earlier_enrichment(self.enrichment), self.before))
            scored = evaluate(records, trend_boards(self.entries, [self.before, self.day]))
            self._evaluations = stored(scored, "evaluations", "capture_date")
        return self._evaluations

    @property
    def current(self) -> DataFrame:
        return self.evaluations.where(F.col("capture_date") == F.lit(self.day))

    @property
    def prior(self) -> DataFrame:
        return self.evaluations.where(F.col("capture_date") == F.lit(self.before))

    def catalog_before(self) -> DataFrame:
        return catalog_upsert(empty_catalog(self.spark), self.prior)

    def catalog(self) -> DataFrame:
        return catalog_upsert(self.catalog_before(), self.current)

    def features(self) -> DataFrame:
        return period_features(self.current, self.catalog(), self.day)


def evidence(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("event_id")
    name = item_name(F.col("user_id"))
    day = F.to_date("ts")
    content = when_mod(e, 17, 4, "{bad", F.col("props"))
    return read_table(spark, folder, "events").select(
        "event_id",
        "ts",
        name.alias("full_name"),
        when_mod(e, 29, 3, "other/item", name).alias("manifest_name"),
        day.alias("cached_day"),
        F.col("event_type").alias("kind"),
        F.concat(F.lit(P.API_SITE + "/"), name, F.lit("/"), "event_type", when_mod(e, 13, 5, "?old", "")).alias("url"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.sha2(F.concat(content, when_mod(e, 19, 6, "x", "")), 256).alias("sha256"),
        F.when(e % 5 != 0, F.date_sub(day, when_mod(e, 3, 0, 1, 0))).alias("fetched_on"),
        content.cast("binary").alias("content"),
    )


# --- documents ---------------------------------------------------------------------------


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(read_table(spark, folder, "documents"), "doc_id")


def web_pages(spark: SparkSession, folder: str) -> DataFrame:
    return spread(read_table(spark, folder, "pages"), "page_id")


def markdown(k: Column, text: Column, lang: Column) -> Column:
    """A Markdown document around the text of a row."""
    n = k.cast("string")
    first = F.substring_index(text, "\n", 1)
    return F.concat(
        when_mod(k, 11, 1, "", F.concat(F.lit("# Item "), n, F.lit("\n\n"))),
        F.lit("## Summary\n\n"), first,
        F.lit("\n\n## Usage\n\n```sh\nrun --id "), n, F.lit(" --lang "), lang, F.lit("\n```\n\n"),
        when_mod(k, 4, 0, F.concat(F.lit("| id | "), n, F.lit(" |\n> "), first, F.lit("\n\n")), ""),
        F.lit("## Notes\n\n"), text, F.lit("\n\n"),
        when_mod(k, 3, 0, F.concat(
            F.lit("![shot](./img/s.png) [guide](../docs/"), lang, F.lit(".md#top)\n\n<video src=\"clip "), n,
            F.lit(".mp4\"></video>\n\n[ref]: docs/ref.md\n\n"),
        ), ""),
        when_mod(k, 5, 0, "<details><summary>more</summary></details>\n\n", ""),
        when_mod(k, 7, 0, "<!-- hidden à note -->\n\n", ""),
        when_mod(k, 13, 0, "TODO_TRANSLATE\n\n", ""),
        when_mod(k, 6, 0, "see https://example.org/à?x=1 and data:image/png;base64,AAAA\n\n", ""),
        when_mod(k, 9, 0, "`inline <table>` code\n\n", ""),
        when_mod(k, 17, 0, "```\nopen fence\n", ""),
    )


def docs_md(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("doc_id")
    return documents(spark, folder).select(
        "doc_id", "lang", "source", "text", markdown(k, F.col("text"), F.col("lang")).alias("md")
    )


#: What stands before the first line of a document and before the others: nothing, a quote, an item, a quote in an item, an
#: item in a quote, the indent of code.
CONTAINERS = (("", ""), ("> ", "> "), ("- ", "  "), ("1. > ", "   > "), ("> - ", ">   "), ("    ", "    "))


def nested_md(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's Markdown inside containers."""
    k = F.col("doc_id") % len(CONTAINERS)
    first, others = (F.element_at(F.array(*[F.lit(c[side]) for c in CONTAINERS]), (k + 1).cast("int")) for side in (0, 1))
    nested = F.concat(first, F.replace("md", F.lit("\n"), F.concat(F.lit("\n"), others)))
    return docs_md(spark, folder).select("doc_id", nested.alias("md"))


def localized_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Each document as a source, its localized variant, and its manifest row."""
    k = F.col("doc_id")
    name = item_name(k, "doc")
    plain = F.regexp_replace("md", r"\A\s+|\s+\z", "")
    body = (
        F.when(k % 19 == 2, F.replace(plain, F.lit("## Usage"), F.lit("Usage")))
        .when(k % 23 == 3, F.replace(plain, F.lit("run --id"), F.lit("exec --id")))
        .when(k % 29 == 4, F.concat(F.lit("# Extra\n\n"), plain))
        .when(k % 31 == 5, F.lit("# T"))
        .when(k % 37 == 6, F.lit("# Same\n\né same body"))
        .otherwise(plain)
    )
    digest = F.sha2("md", 256)
    url = F.concat(canonical_url(name), F.lit("/blob/main/README.md"))
    mode = when_mod(k, 4, 1, P.MODE_COPY, P.MODE_TRANSLATION)
    base = docs_md(spark, folder).select(
        "doc_id", "md", body.alias("body"), name.alias("full_name"), digest.alias("source_sha256"),
        url.alias("source_url"), mode.alias("mode"),
    )
    document = F.concat(
        F.lit("---\nfull_name: "), "full_name", F.lit("\nsource_url: "), "source_url",
        F.lit("\nsource_sha256: "), when_mod(k, 47, 9, "zz", F.col("source_sha256")),
        F.lit("\nlanguage: "), when_mod(k, 41, 7, "en", P.LOCAL_LANGUAGE),
        when_mod(k, 43, 8, "", F.concat(F.lit("\nmode: "), "mode")), F.lit("\n---\n\n"), "body",
    )
    path = F.concat(F.lit("readmes/"), F.replace("full_name", F.lit("/"), F.lit("__")), F.lit(f".{P.LOCAL_LANGUAGE}.md"))
    return base.withColumn("document", document).select(
        "*",
        (F.octet_length("md") + when_mod(k, 53, 10, 1, 0)).alias("source_bytes"),
        F.concat(F.lit("readmes/sources/"), "source_sha256", F.lit(".md")).alias("source_artifact"),
        path.alias("translation"),
        when_mod(k, 59, 11, "0", F.sha2("document", 256)).alias("translation_sha256"),
        (F.octet_length("body") + when_mod(k, 61, 12, 1, 0)).alias("translation_bytes"),
    )


def localized_tables(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(manifest, files, sources) with some files missing and some sources changed."""
    k = F.col("doc_id")
    manifest = docs.select(
        "full_name", "source_url", "source_sha256", "source_artifact", "source_bytes", "mode", "translation",
        "translation_sha256", "translation_bytes",
    )
    files = docs.where(k % 67 != 13).select(F.col("translation").alias("path"), F.col("document").alias("text"))
    sources = docs.select(
        F.col("source_artifact").alias("path"), F.concat("md", when_mod(k, 71, 14, "x", "")).alias("text")
    )
    return manifest, files, sources


def report_texts(spark: SparkSession, folder: str) -> DataFrame:
    """A daily report around each document; some lack a section, some have a phrase that reports must not have."""
    k = F.col("doc_id")
    sections = [
        when_mod(k, 7, i, "", F.concat(F.lit(f"## {name}\n\n"), F.substring_index("text", "\n", 1), F.lit("\n\n"))) for i, name in enumerate(P.REQUIRED_REPORT_SECTIONS)
    ]
    phrases = [when_mod(k, 11 + 2 * i, 3, phrase + "\n\n", "") for i, phrase in enumerate(P.FORBIDDEN_REPORT_PHRASES)]
    return documents(spark, folder).select("doc_id", F.concat(*sections, *phrases).alias("report"))


def localized_set(docs: DataFrame) -> tuple[DataFrame, ...]:
    """(header, manifest, files, sources, displayed, catalog): the tables above with faults of the set. Some entries are
    missing or given twice, some names not displayed or not in the catalog, some files strays, the header is wrong."""
    k = F.col("doc_id")
    _, files, sources = localized_tables(docs)
    listed = docs.where(k % 79 != 18)
    manifest, _, _ = localized_tables(listed.unionByName(listed.where(k % 83 == 15)))
    stray = F.concat(F.lit("readmes/stray-"), k.cast("string"), F.lit(f".{P.LOCAL_LANGUAGE}.md"))
    strays = docs.where(k % 97 == 17).select(stray.alias("path"), F.lit("").alias("text"))
    header = docs.agg(F.count("*").alias("entry_count")).withColumn("schema_version", F.lit(P.MANIFEST_VERSION + 1))
    displayed, catalog = (docs.where(k % n != rest).select("full_name") for n, rest in ((89, 16), (73, 21)))
    return header, manifest, files.unionByName(strays), sources, displayed, catalog


def document_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, sha256) as once committed: some hashes differ from the files, some files are gone."""
    k = F.col("doc_id")
    body = F.concat(F.col("text"), when_mod(k, 10, 7, "!", ""))
    path = F.concat(F.lit("docs/"), (k + when_mod(k, 50, 9, 1000000000, 0)).cast("string"), F.lit(".md"))
    return documents(spark, folder).select(
        path.alias("path"), F.sha2(body, 256).alias("sha256"), F.octet_length("text").alias("bytes"), "doc_id"
    )


def document_files(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("doc_id").cast("string")
    return documents(spark, folder).select(
        F.concat(F.lit("docs/"), k, F.lit(".md")).alias("path"), F.col("text").cast("binary").alias("content")
    )


# --- pages -----------------------------------------------------------------------------------


def board_html(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages with their navigation items written as board rows, in four spellings of HTML; some
    are empty boards, some have a row without link or without end, some are left as they are."""
    k = F.col("page_id")
    n = k.cast("string")
    row = F.concat(
        F.lit('<article class="Box-row"><h2><a href="/org'), n, F.lit('/$1"> $1 </a></h2><p class="col-9">About <b>$2</b> &amp; more</p>'),
        when_mod(k, 2, 0, '<span itemprop="programmingLanguage">Lang</span>', ""),
        F.lit('<a href="/org'), n, F.lit('/$1/stargazers">'), n, F.lit(',234</a><a href="/org'), n, F.lit('/$1/forks">1.2k</a>'),
        when_mod(k, 3, 0, F.concat(F.lit('<span class="float-sm-right">'), n, F.lit(" stars today</span>")), ""),
        F.lit('<span class="d-inline-block"><img alt="@$1"></span></article>'),
    )
    bare = F.regexp_replace(row, '="([^"]*)"', "=$1")
    for lower, upper in (("article", "ARTICLE"), ("<h2", "<H2"), ("</h2", "</H2"), (" class=", " CLASS="), (" href=", " HREF=")):
        bare = F.replace(bare, F.lit(lower), F.lit(upper))
    coded = F.replace(F.replace(row, F.lit("&amp;"), F.lit("&#38;")), F.lit("About"), F.lit("&#x41;bout"))
    spelled = F.when(k % 4 == 1, F.replace(row, F.lit('"'), F.lit("'"))).when(k % 4 == 2, bare).when(k % 4 == 3, coded).otherwise(row)
    boards = F.regexp_replace("html", F.lit(r'<li><a href="/([^"]*)">([^<]*)</a></li>'), spelled)
    broken = F.regexp_replace(boards, "<[hH]2>", "<h3>")
    unended = F.regexp_replace(boards, "</(?:article|ARTICLE)>", "")
    empty = F.concat(F.lit("<h1>Trending</h1><p>It looks like we don't have any trending repositories "), n, F.lit("</p>"))
    html = (
        F.when(k % 10 == 7, broken)
        .when(k % 10 == 8, empty)
        .when(k % 10 == 9, F.col("html"))
        .when(k % 20 == 3, unended)
        .otherwise(boards)
    )
    return web_pages(spark, folder).select("page_id", html.alias("html"))


def site_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of a site: the path comes from the first navigation item; links are written
    relative, through a parent folder, from the root, or leave the site."""
    k = F.col("page_id")
    slug = F.regexp_extract("html", r'<a href="/([^"]*)"', 1)
    html = (
        F.when(k % 3 == 0, F.regexp_replace("html", r'href="/([^"]*)"', 'href="$1.html"'))
        .when(k % 3 == 1, F.regexp_replace("html", r'href="/([^"]*)"', 'href="../repos/$1.html?v=1#top"'))
        .when(k % 6 == 2, F.col("html"))
        .otherwise(F.regexp_replace("html", r'href="/([^"]*)"', 'href="https://example.org/$1"'))
    )
    # every second page writes its attributes in another way
    html = F.when(k % 4 == 1, F.regexp_replace(html, '<a href="([^"]*)"', "<A class='x' HREF=$1")).when(k % 4 == 3, F.replace(html, F.lit('"'), F.lit("'"))).otherwise(html)
    outline = F.concat(F.lit('<h2 id="s'), k.cast("string"), F.lit('">About <i>'), slug, F.lit('</i></h2><h2 id="end">End</h2>'))
    outline = F.when(k % 4 == 1, F.regexp_replace(outline, '<h2 id="([^"]*)"', "<H2 ID=$1")).when(k % 4 == 3, F.replace(outline, F.lit('"'), F.lit("'"))).otherwise(outline)
    return web_pages(spark, folder).select(
        "page_id",
        F.concat(F.lit("repos/"), slug, F.lit(".html")).alias("path"),
        F.concat(html, outline).alias("html"),
    )


def rendered_pages(docs: DataFrame) -> DataFrame:
    """Detail pages with the localized body embedded; some stale, some with lost or escaped tags."""
    k = F.col("doc_id")
    content = (
        F.when(k % 8 == 1, F.regexp_replace("body", "<video[^>]*></video>", ""))
        .when(k % 8 == 2, F.replace("body", F.lit("<details>"), F.lit("&lt;details>")))
        .otherwise(F.col("body"))
    )
    body = F.concat(F.lit('<div class="localized-readme-body">'), content, F.lit("<img src=x><pre>&lt;table</pre></div>"))
    digest = F.sha2(F.concat(body, when_mod(k, 9, 3, "x", "")), 256)
    section = F.concat(
        F.lit(f'<section class="localized-readme" id="{P.LOCAL_SECTION_ID}" data-source-sha256="'),
        when_mod(k, 13, 4, "0", F.col("source_sha256")), F.lit('" data-translation-sha256="'), "translation_sha256",
        F.lit('" data-rendered-sha256="'), digest, F.lit('">'), body, F.lit("</section>"),
    )
    html = F.concat(F.lit("<main>"), when_mod(k, 15, 5, "", section), F.lit("</main>"))
    return docs.select("full_name", html.alias("html"))
