"""Ranked boards: building them from events or pages, and consolidating them by key."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions import markup as M
from rankloom.functions.rows import unnest
from rankloom.functions.scalars import parse_compact_number, round2

ROW_START = M.opening("article", M.has_class("Box-row"))
ROW = M.element("article", M.has_class("Box-row"))
HEADING_NODE = M.element("h2")
LINK = M.attribute_in("a", "href")
ROW_TEXT = M.element("p", M.has_class("col-9"))
ANY_TEXT = M.element("p")
LANGUAGE = rf"(?is)<(\w+)(?=[\s>/]){M.has_value('itemprop', 'programmingLanguage')}{M.INSIDE}>(.*?)</\1\s*>"
PERIOD_NODE = M.element("span", M.has_class("float-sm-right"))
BUILDER_NODE = M.element("span", M.has_class("d-inline-block"))
BUILDER_ALT = M.attribute_in("img", "alt")


def page_number(period_no: Column, scope_no: Column) -> Column:
    """Period-major number of a page, distinct for any number of scopes below 2 ** 40."""
    return F.shiftleft(period_no.cast("bigint"), 40) + scope_no


def board_matrix(
    scopes: DataFrame, periods: tuple[str, ...] = P.PERIODS, site: str = P.SITE, base_path: str = P.BOARD_PATH
) -> DataFrame:
    """Every (period, scope) page, period-major, with its URL and slug.

    ``scopes`` has columns (scope, scope_no). Each scope row is expanded by the fixed
    period list, so no join is needed. The ``global`` scope has no path segment.
    """
    expanded = scopes.select("scope", "scope_no", F.posexplode(F.array(*map(F.lit, periods))).alias("p", "period"))
    segment = F.when(F.col("scope") == "global", "").otherwise(F.concat(F.lit("/"), F.col("scope")))
    return expanded.select(
        page_number(F.col("p"), F.col("scope_no")).alias("page_no"),
        "scope",
        "period",
        F.concat(
            F.lit(site + base_path), segment, F.lit("?since="), F.col("period"), F.lit("&spoken_language_code=")
        ).alias("url"),
        F.concat_ws("-", "scope", "period").alias("slug"),
    )


def board_totals(daily: DataFrame, captures: list[date], period_days: dict[str, int] = P.PERIOD_DAYS) -> DataFrame:
    """Trailing totals per (capture_date, scope, period, item) from daily totals.

    ``daily`` is (day, scope, item, metric, hits). Each daily row is sent to the windows
    it falls in, and once more to the ``global`` scope. There is no range join: the
    windows are a short literal list, and the totals are combined before the shuffle.
    """
    windows = [(c, p, c - timedelta(days=n - 1)) for c in captures for p, n in period_days.items()]
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col("day").between(F.lit(start), F.lit(capture)),
                    F.struct(F.lit(capture).alias("capture_date"), F.lit(period).alias("period")),
                )
                for capture, period, start in windows
            ]
        )
    )
    first = min(start for _, _, start in windows)
    in_reach = daily.where(F.col("day").between(F.lit(first), F.lit(max(captures))))
    spread = in_reach.withColumn("w", F.explode(hits)).withColumn(
        "scope", F.explode(F.array(F.lit("global"), F.col("scope")))
    )
    return spread.groupBy("w.capture_date", "scope", "w.period", "item").agg(
        F.sum("metric").alias("metric"), F.sum("hits").alias("hits")
    )


def daily_totals(events: DataFrame) -> DataFrame:
    """Events (ts, scope, item, metric) combined to one row per (day, scope, item)."""
    return events.groupBy(F.to_date("ts").alias("day"), "scope", "item").agg(
        F.sum("metric").alias("metric"), F.count("*").alias("hits")
    )


def rank_boards(totals: DataFrame, top: int = 25) -> DataFrame:
    """Top rows of each board. The ``<= top`` filter on ``row_number`` is cut per task
    before the shuffle (window group limit), so a board never gathers its whole scope."""
    board = Window.partitionBy("capture_date", "scope", "period").orderBy(F.desc("metric"), "item")
    return totals.withColumn("rank", F.row_number().over(board)).where(F.col("rank") <= top)


def board_rows(
    events: DataFrame, captures: list[date], top: int = 25, period_days: dict[str, int] = P.PERIOD_DAYS
) -> DataFrame:
    """Boards straight from events; the date range reaches the scan as a pushed filter."""
    first = min(captures) - timedelta(days=max(period_days.values()) - 1)
    last = max(captures) + timedelta(days=1)
    in_range = events.where((F.col("ts") >= F.lit(str(first)).cast("timestamp")) & (
        F.col("ts") < F.lit(str(last)).cast("timestamp")
    ))
    return rank_boards(board_totals(daily_totals(in_range), captures, period_days), top)


# --- pages -----------------------------------------------------------------------


def node_text(markup: Column) -> Column:
    """Text of a node: pieces between tags, each trimmed, joined by one blank, references decoded."""
    pieces = F.transform(F.split(markup, rf"(?s)<!--.*?-->|<[/!?a-zA-Z]{M.INSIDE}>"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return M.unescape(F.array_join(F.filter(pieces, lambda x: x != ""), " "))


def _first(markup: Column, pattern: str, group: int = 1) -> Column:
    """First captured group, null when the pattern does not occur (an empty node gives '')."""
    return F.try_element_at(F.regexp_extract_all(markup, F.lit(pattern), F.lit(group)), F.lit(1))


def _links(markup: Column) -> Column:
    """The links of a row with their targets."""
    found = F.regexp_extract_all(markup, F.lit(M.element("a")), F.lit(0))
    return F.transform(found, lambda a: F.struct(M.value_of(_first(a, LINK)).alias("target"), a.alias("node")))


def _link_text(links: Column, full_name: Column, leaf: str) -> Column:
    """Text of the link to ``/<full_name>/<leaf>``; null when there is none."""
    wanted = F.concat(F.lit("/"), full_name, F.lit(f"/{leaf}"))
    same = lambda a: F.coalesce(a["target"] == wanted, F.lit(False))
    return node_text(F.try_element_at(F.filter(links, same), F.lit(1))["node"])


def _row_key(markup: Column) -> Column:
    headings = F.array_join(F.regexp_extract_all(markup, F.lit(HEADING_NODE), F.lit(1)), " ")
    full_name = F.regexp_replace(M.value_of(_first(headings, LINK)), "^/+|/+$", "")
    return F.struct(full_name.alias("full_name"), _first(markup, PERIOD_NODE).alias("period_node"), markup.alias("markup"), _links(markup).alias("links"))


def _row_struct(row: Column, position: Column) -> Column:
    markup, full_name = row["markup"], row["full_name"]
    period_text = node_text(row["period_node"])
    builders = F.flatten(
        F.transform(
            F.regexp_extract_all(markup, F.lit(BUILDER_NODE), F.lit(1)),
            lambda node: F.regexp_extract_all(node, F.lit(BUILDER_ALT), F.lit(1)),
        )
    )
    return F.struct(
        (position + 1).cast("int").alias("rank"),
        full_name.alias("full_name"),
        F.concat(F.lit(P.SITE + "/"), full_name).alias("url"),
        F.coalesce(node_text(F.coalesce(_first(markup, ROW_TEXT), _first(markup, ANY_TEXT))), F.lit("")).alias(
            "description"
        ),
        node_text(_first(markup, LANGUAGE, 2)).alias("primary_language"),
        F.coalesce(M.computed_once(_link_text(row["links"], full_name, "stargazers"), parse_compact_number), F.lit(0)).alias("total_stars"),
        F.coalesce(M.computed_once(_link_text(row["links"], full_name, "forks"), parse_compact_number), F.lit(0)).alias("total_forks"),
        M.computed_once(period_text, lambda text: F.when(text != "", parse_compact_number(text))).alias("period_stars"),
        F.transform(
            F.filter(F.transform(builders, M.value_of), lambda a: a != ""), lambda a: F.regexp_replace(a, "^@+", "")
        ).alias("built_by"),
    )


def parse_boards(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``status``, ``error`` and ``entries`` to each page, all inside the row.

    A row without a usable key fails its page, and so does a row that is begun and not ended. Without
    rows a page succeeds only when it says that the board is empty under a heading that names the board.
    """
    live = F.regexp_replace(F.col(html), M.COMMENT, "")
    rows = F.regexp_extract_all(live, F.lit(ROW), F.lit(1))
    parsed = pages.withColumn("_keys", F.transform(rows, _row_key)).withColumn("_starts", F.regexp_count(live, F.lit(ROW_START)))
    heading = node_text(_first(live, M.element("h1")))
    empty = F.contains(F.lower(heading), F.lit("trending")) & node_text(live).rlike(P.EMPTY_BOARD)
    bad_key = F.exists("_keys", lambda r: ~F.coalesce(r["full_name"].rlike("^[^/]*/[^/]*$"), F.lit(False)))
    no_link = F.exists("_keys", lambda r: r["full_name"].isNull())
    error = (
        F.when(F.col("_starts") != F.size("_keys"), "unended_row")
        .when((F.size("_keys") == 0) & ~F.coalesce(empty, F.lit(False)), "unrecognized_page")
        .when(no_link, "row_without_link")
        .when(bad_key, "invalid_row_key")
    )
    failed = F.col("error").isNotNull()
    return (
        parsed.withColumn("error", error)
        .withColumn("status", F.when(failed, "failed").otherwise("success"))
        .withColumn("_keys", F.when(failed, F.slice("_keys", 1, 0)).otherwise(F.col("_keys")))
        .withColumn("entries", F.transform("_keys", _row_struct))
        .drop("_keys", "_starts")
    )


def parsed_entries(parsed: DataFrame, *keys: str) -> DataFrame:
    """One row per ranked row; failed pages have none. A filter on the status is left out on
    purpose: pushed to the scan, it would parse every page once more."""
    return unnest(parsed, F.col("entries"), "entry", *keys).select(*keys, "entry.*")


def page_status(parsed: DataFrame, *keys: str) -> DataFrame:
    return parsed.select(*keys, "status", "error", F.size("entries").alias("entry_count"))


def page_hash_manifest(pages: DataFrame, key: str, content: str) -> DataFrame:
    body = F.col(content).cast("binary")
    return pages.select(key, F.sha2(body, 256).alias("sha256"), F.octet_length(body).alias("bytes"))


def success_pages_only(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("status") == "success")


# --- consolidation -----------------------------------------------------------------


def consolidate(entries: DataFrame, by: tuple[str, ...] = ("capture_date", "full_name")) -> DataFrame:
    """One row per candidate: first-seen attributes in (page, rank) order, highest totals and the
    number of appearances. All of it is combined per task before the shuffle; the appearances
    themselves stay rows (see ``appearances``), so a candidate on very many pages is no burden."""
    seen = F.struct("url", "description", "primary_language")
    grouped = success_pages_only(entries).groupBy(*by).agg(
        F.min_by(seen, F.struct("page_no", "rank")).alias("seen"),
        F.max("total_stars").alias("total_stars"),
        F.max("total_forks").alias("total_forks"),
        F.count("*").alias("appearance_count"),
    )
    return grouped.select(*by, "seen.*", "total_stars", "total_forks", "appearance_count")


def appearances(entries: DataFrame) -> DataFrame:
    """Every appearance of every candidate on a successful page, one per row."""
    columns = ("page_no", "scope", "period", "rank", "period_stars", "source_url", "raw_sha256")
    return success_pages_only(entries).select("capture_date", "full_name", *columns)


def candidate_measures(entries: DataFrame, by: tuple[str, ...] = ("capture_date", "full_name")) -> DataFrame:
    """All measures the scorer needs in one hash aggregate: ranks, period maxima, presence."""
    per_period = [
        F.max(F.when(F.col("period") == p, F.col("period_stars"))).alias(f"{p}_stars") for p in P.PERIODS
    ]
    present = [F.max((F.col("period") == p).cast("int")).alias(f"in_{p}") for p in P.PERIODS]
    return success_pages_only(entries).groupBy(*by).agg(
        F.avg("rank").alias("average_rank"), F.count("*").alias("appearance_count"), *per_period, *present
    )


def average_rank(entries: DataFrame, by: tuple[str, ...] = ("capture_date", "full_name")) -> DataFrame:
    mean = success_pages_only(entries).groupBy(*by).agg(F.avg("rank").alias("mean_rank"))
    return mean.select(*by, round2(F.col("mean_rank")).alias("average_rank"))


def period_max_pivot(entries: DataFrame, by: tuple[str, ...] = ("capture_date", "full_name")) -> DataFrame:
    return candidate_measures(entries, by).select(*by, *[f"{p}_stars" for p in P.PERIODS])


def periods_present() -> Column:
    """Sorted names of the periods a candidate was seen in, from the ``in_<period>`` flags."""
    return F.array_compact(F.array(*[F.when(F.col(f"in_{p}") == 1, F.lit(p)) for p in sorted(P.PERIODS)]))


def cross_period(entries: DataFrame, by: tuple[str, ...] = ("capture_date", "full_name")) -> DataFrame:
    measures = candidate_measures(entries, by).withColumn("periods_present", periods_present())
    share = F.size("periods_present") * 100.0 / len(P.PERIODS)
    return measures.select(*by, round2(share).alias("cross_period"), "appearance_count", "periods_present")


def distinct_candidates(entries: DataFrame) -> DataFrame:
    return success_pages_only(entries).select("full_name").distinct()


def name_order(df: DataFrame, name: str = "full_name") -> DataFrame:
    """Case-insensitive order with the raw name as tie-break: a distributed range sort."""
    return df.orderBy(F.lower(name), name)


def collection_summary(pages: DataFrame, entries: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row of counts over a capture: pages, candidates, failures, evidence reuse.

    The three inputs are reduced to tagged partial counts and combined in one aggregate.
    ``evidence`` has (status, reused).
    """
    zero = F.lit(0).cast("bigint")
    names = ("page_count", "successful_pages", "failures", "candidate_count", "cache_hits", "evidence_fetches", "evidence_failures")

    def counts(df: DataFrame, **values: Column) -> DataFrame:
        return df.agg(*[values.get(n, zero).alias(n) for n in names])

    ok = F.col("status") == "success"
    parts = (
        counts(pages, page_count=F.count("*"), successful_pages=F.count_if(ok), failures=F.count_if(~ok))
        .unionByName(counts(distinct_candidates(entries), candidate_count=F.count("*")))
        .unionByName(
            counts(
                evidence,
                cache_hits=F.count_if(F.col("reused")),
                evidence_fetches=F.count_if(~F.col("reused")),
                evidence_failures=F.count_if(~ok),
            )
        )
    )
    return parts.agg(*[F.sum(n).alias(n) for n in names])
