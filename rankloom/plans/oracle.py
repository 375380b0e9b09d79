"""The same queries in SQL, for a second engine to check the results.

``VIEWS`` mirrors the views of ``plans.views``; ``sql`` puts the ones a statement needs in
front of it.
"""

from __future__ import annotations

import re

from rankloom import params as P
from rankloom.operators import digest_tree as T
from rankloom.plans import queries as Q
from rankloom.plans.views import BETWEEN, KINDS, SCOPES, SCRIPT, TOP

C = "(SELECT CAST(max(ts) AS DATE) FROM events)"
B = f"({C} - {BETWEEN})"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(quote(i) for i in items) + "]"


def name(item: str, kind: str = "item") -> str:
    return f"('org' || ({item} % 7) || '/{kind}' || {item})"


def violations(*rules: tuple[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {condition} THEN {quote(rule)} END" for condition, rule in rules)
    return f"coalesce(array_to_string([{cases}], ','), '')"


def round2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(20,8)), 2) AS DOUBLE)"


def sub(text: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({text}, {quote(pattern)}, {quote(to)}, 'g')"


def hits(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {quote(pattern)})"


PERIOD_NO = "(list_position(['daily','weekly','monthly'], period) - 1)"
SCOPE_NO = f"(list_position({sql_list(SCOPES)}, scope) - 1)"


def windows() -> str:
    rows = []
    for day in (B, C):
        for period, days in P.PERIOD_DAYS.items():
            rows.append(f"({day}, '{period}', {day} - {days - 1})")
    return ", ".join(rows)


def component_list(k: str, limits: dict[str, int], step: int, over: bool) -> str:
    out = []
    for i, limit in enumerate(limits.values()):
        value = f"{limit} - ({k} * {i + step}) % {limit // 2 + 1}"
        if over and i == 0:
            value = f"CASE WHEN {k} % 47 = 7 THEN {limit + 1} ELSE {value} END"
        out.append(f"({value})")
    return "[" + ", ".join(out) + "]"


def in_limits(scores: str, limits: dict[str, int]) -> str:
    return "(" + " AND ".join(f"{scores}[{i}] BETWEEN 0 AND {v}" for i, v in enumerate(limits.values(), 1)) + ")"


def script_chars(x: str) -> str:
    prose = sub(sub(sub(sub(x, r"(?s)<!--.*?-->"), r"(?s)```.*?```"), r"data:[^\s)\"']+"), r"https?://\S+")
    return f"length({sub(prose, f'[^{SCRIPT}]')})"


def foreign_passage(x: str) -> str:
    for pattern in (
        r"(?s)<!--.*?-->", r"(?s)```.*?```", r"(?m)^[ \t]*[|>].*$", r"`[^`]+`", r"data:[^\s)\"']+", r"https?://\S+",
    ):
        x = sub(x, pattern)
    return hits(sub(x, r"\s+", " "), f"[A-Za-z][{P.FOREIGN_RUN}]{{{P.DOCUMENT_FOREIGN_RUN_MIN},}}")


FENCE = r"(?ms)^```([^\n]*)\n(.*?)^```[ \t]*$"
HEADING = r"(?m)^#{1,6}(?:[ \t]|$)"


def fences(x: str, group: int) -> str:
    return f"regexp_extract_all({x}, {quote(FENCE)}, {group})"


def blocks(x: str) -> str:
    return f"list_transform(list_zip({fences(x, 1)}, {fences(x, 2)}), lambda z: trim(z[1]) || chr(10) || z[2])"


def headings(x: str) -> str:
    return f"list_transform(regexp_extract_all({sub(x, FENCE)}, {quote(HEADING)}), lambda h: length(trim(h, ' ' || chr(9))))"


def unclosed(x: str) -> str:
    return hits(sub(x, FENCE), r"(?m)^```")


def media(x: str) -> str:
    live = sub(sub(x, r"(?s)```.*?```|~~~.*?~~~"), r"`[^`\n]*`")
    tests = []
    for tag in sorted(P.MEDIA_TAGS):
        test = hits(live, rf"(?i)<{tag}\b")
        if tag == "img":
            test = f"({test} OR {hits(live, r'!\[[^\]]*\]\([^)]+\)')})"
        tests.append(f"CASE WHEN {test} THEN '{tag}' END")
    return "[" + ", ".join(tests) + "]"


def prose(x: str) -> str:
    bare = sub(sub(x, FENCE), r"`[^`\n]*`", " ")
    bare = sub(bare, r"(!?)\[([^\]]*)\]\([^)]*\)", r"\2")
    bare = sub(bare, r"<[^>\n]*>", " ")
    bare = sub(bare, r"(?m)^[ \t]*(?:#{1,6}|>|[-*+]|\d+[.)])[ \t]+")
    return f"trim({sub(bare, r'\s+', ' ')})"


def odd_fences(x: str) -> str:
    return f"((length({x}) - length(replace({x}, '```', ''))) // 3 % 2 = 1)"


def section(x: str, heading: str) -> str:
    found = f"regexp_extract({x} || chr(10) || '## ', {quote(rf'(?s)(?:\A|\n)## {heading}[ \t]*\n(.*?)\n## ')}, 1)"
    return sub(found, r"\A\s+|\s+\z")


def structure_rules(mode: str, body: str, source: str) -> list[tuple[str, str]]:
    copy = f"{mode} = '{P.MODE_COPY}'"
    p = prose(source)
    words = f"length(regexp_extract_all({p}, '[A-Za-z]{{3,}}'))"
    return [
        (f"{unclosed(source)} OR (NOT ({copy}) AND {unclosed(body)})", "unclosed_fence"),
        (f"{copy} AND {script_chars(p)} < greatest(1, {words})", "copy_not_native"),
        (f"{copy} AND {body} <> {sub(source, chr(92) + 'A' + chr(92) + 's+|' + chr(92) + 's+' + chr(92) + 'z')}", "copy_differs"),
        (f"NOT ({copy}) AND {blocks(body)} <> {blocks(source)}", "code_blocks"),
        (
            f"NOT ({copy}) AND NOT ({headings(body)} = {headings(source)} OR {headings(body)} = list_concat([1], {headings(source)}))",
            "headings",
        ),
    ]


def prose_rules(mode: str, body: str, source: str) -> list[tuple[str, str]]:
    copy = f"{mode} = '{P.MODE_COPY}'"
    needed = f"CASE WHEN {copy} THEN least({P.NATIVE_CHARS_MIN}, {script_chars(source)}) ELSE {P.NATIVE_CHARS_MIN} END"
    tokens = " OR ".join(f"contains({body}, {quote(t)})" for t in P.PLACEHOLDERS)
    return [
        (f"NOT ({copy}) AND NOT {hits(body, r'(?m)^# .+')}", "no_title"),
        (f"{script_chars(body)} < {needed}", "too_little_native"),
        (foreign_passage(body), "foreign_passage"),
        (tokens, "placeholder"),
        (odd_fences(body), "odd_fences"),
    ]


def length_rules(mode: str, body: str) -> list[tuple[str, str]]:
    return [
        (f"translation_bytes <> strlen({body})", "translation_bytes"),
        (
            f"{mode} = '{P.MODE_TRANSLATION}' AND source_bytes > 0 AND translation_bytes < source_bytes * {P.LENGTH_RATIO_MIN}",
            "too_short",
        ),
    ]


STRIP = r"\A\s+|\s+\z"

TREND = """
  SELECT full_name,
    {parts},
    CAST(round({exact}, 2) AS DOUBLE) AS trend_score, ({exact}) >= {trend_pass} AS trend_pass,
    daily_stars, weekly_stars, monthly_stars, appearance_count, periods_present,
    {avg_now} AS average_rank, {avg_before} AS previous_average_rank
  FROM (
    SELECT m.*, dp.p AS daily_p, wp.p AS weekly_p, mp.p AS monthly_p,
      CASE WHEN before_rank IS NULL THEN 50.0
        ELSE greatest(0.0, least(100.0, 50.0 + (before_rank - now_rank) * 5.0)) END AS momentum,
      100.0 * n_periods / 3.0 AS cross_p
    FROM measures_{tag} m
    JOIN daily_rank_{tag} dp USING (full_name) JOIN weekly_rank_{tag} wp USING (full_name)
    JOIN monthly_rank_{tag} mp USING (full_name)
  )
"""


def trend_view(tag: str) -> str:
    columns = {
        "weekly_percentile": "weekly_p", "daily_percentile": "daily_p", "monthly_percentile": "monthly_p",
        "rank_momentum": "momentum", "cross_period": "cross_p",
    }
    parts = ", ".join(f"{round2(columns[n])} AS {n}" for n in P.TREND_WEIGHTS)
    exact = " + ".join(
        f"CAST(round(CAST({columns[n]} AS DECIMAL(20,8)), 2) * CAST({w} AS DECIMAL(3,2)) AS DECIMAL(20,8))"
        for n, w in P.TREND_WEIGHTS.items()
    )
    return TREND.format(
        parts=parts, exact=exact, tag=tag, trend_pass=P.TREND_PASS, avg_now=round2("now_rank"), avg_before=round2("before_rank")
    )


def measures_view(day: str) -> str:
    stars = ", ".join(f"max(period_stars) FILTER (period = '{p}') AS {p}_stars" for p in P.PERIODS)
    return f"""
      SELECT full_name, now.*  EXCLUDE (full_name), before_rank FROM (
        SELECT full_name, avg(rank) AS now_rank, count(*) AS appearance_count, {stars},
          count(DISTINCT period) AS n_periods,
          array_to_string(list_sort(list_distinct(list(period))), ',') AS periods_present
        FROM board WHERE status = 'success' AND capture_date = {day} GROUP BY full_name) now
      LEFT JOIN (
        SELECT full_name, avg(rank) AS before_rank FROM board WHERE status = 'success' AND capture_date =
          (SELECT max(capture_date) FROM board WHERE status = 'success' AND capture_date < {day})
        GROUP BY full_name) USING (full_name)"""


def rank_view(tag: str, period: str) -> str:
    s = f"{period}_stars"
    return f"""
      SELECT full_name, CASE WHEN {s} IS NULL OR k < 2 THEN 50.0
        ELSE 100.0 * (less + (equal - 1) / 2) / (k - 1) END AS p
      FROM (SELECT full_name, {s}, count({s}) OVER () AS k,
        rank() OVER (PARTITION BY {s} IS NULL ORDER BY {s}) - 1 AS less,
        count(*) OVER (PARTITION BY {s}) AS equal FROM measures_{tag})"""


def evaluation_view(day: str, tag: str, enrichment: str) -> str:
    final = (
        f"CAST(round(CAST(CAST(trend_score AS DECIMAL(9,2)) * 0.20 AS DECIMAL(20,8)) + quality_total * 0.45 + value_total * 0.35, 2) AS DOUBLE)"
    )
    return f"""
      SELECT *, CASE WHEN rejection_stage IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
        CASE rejection_stage WHEN 'hard_filter' THEN gate_failures WHEN 'trend' THEN 'trend_score_below_40'
          WHEN 'quality' THEN 'quality_score_below_60' WHEN 'value' THEN 'value_score_below_60'
          WHEN 'final' THEN 'final_score_below_65' ELSE '' END AS rejection_reasons
      FROM (SELECT *, CASE WHEN gate_failures <> '' THEN 'hard_filter' WHEN NOT trend_pass THEN 'trend'
          WHEN quality_total < 60 THEN 'quality' WHEN value_total < 60 THEN 'value'
          WHEN grade IS NULL THEN 'final' END AS rejection_stage
        FROM (SELECT *, CASE WHEN final_score >= 85 THEN 'S' WHEN final_score >= 75 THEN 'A'
            WHEN final_score >= 65 THEN 'B' END AS grade
          FROM (SELECT e.*, t.* EXCLUDE (full_name), {day} AS capture_date, {final} AS final_score,
              date_diff('day', created_day, {day}) AS age,
              CASE WHEN contains(periods_present, 'daily')
                AND (NOT contains(periods_present, 'weekly') OR daily_percentile >= weekly_percentile)
                AND (NOT contains(periods_present, 'monthly') OR daily_percentile >= monthly_percentile) THEN 'daily'
              WHEN contains(periods_present, 'weekly')
                AND (NOT contains(periods_present, 'monthly') OR weekly_percentile >= monthly_percentile) THEN 'weekly'
              ELSE 'monthly' END AS primary_period
            FROM {enrichment} e JOIN trend_{tag} t USING (full_name))))"""


def gate_cases(extra: str = "false") -> str:
    cases = [f"CASE WHEN {f} THEN '{f}' END" for f in P.STATE_FLAGS]
    for i, gate in enumerate(P.GATES):
        failed = f"k % {29 + 2 * i} = 5"
        if gate == "readme_clear":
            failed = f"({failed} OR {extra})"
        cases.append(f"CASE WHEN {failed} THEN '{gate}' END")
    return "coalesce(array_to_string([" + ", ".join(cases) + "], ','), '')"


N = "chr(10)"
MD = f"""
    CASE WHEN k % 11 = 1 THEN '' ELSE '# Item ' || k || {N} || {N} END
    || '## Summary' || {N} || {N} || first || {N} || {N} || '## Usage' || {N} || {N} || '```sh' || {N} || 'run --id ' || k
    || ' --lang ' || lang || {N} || '```' || {N} || {N}
    || CASE WHEN k % 4 = 0 THEN '| id | ' || k || ' |' || {N} || '> ' || first || {N} || {N} ELSE '' END
    || '## Notes' || {N} || {N} || text || {N} || {N}
    || CASE WHEN k % 3 = 0 THEN '![shot](./img/s.png) [guide](../docs/' || lang || '.md#top)' || {N} || {N}
      || '<video src="clip ' || k || '.mp4"></video>' || {N} || {N} || '[ref]: docs/ref.md' || {N} || {N} ELSE '' END
    || CASE WHEN k % 5 = 0 THEN '<details><summary>more</summary></details>' || {N} || {N} ELSE '' END
    || CASE WHEN k % 7 = 0 THEN '<!-- hidden à note -->' || {N} || {N} ELSE '' END
    || CASE WHEN k % 13 = 0 THEN 'TODO_TRANSLATE' || {N} || {N} ELSE '' END
    || CASE WHEN k % 6 = 0 THEN 'see https://example.org/à?x=1 and data:image/png;base64,AAAA' || {N} || {N} ELSE '' END
    || CASE WHEN k % 9 = 0 THEN '`inline <table>` code' || {N} || {N} ELSE '' END
    || CASE WHEN k % 17 = 0 THEN '```' || {N} || 'open fence' || {N} ELSE '' END"""

VIEWS = {
    "totals": f"""
      SELECT w.day AS capture_date, s.scope, w.period, user_id AS item,
        CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS metric, count(*) AS hits
      FROM events JOIN (VALUES {windows()}) w(day, period, first_day)
        ON CAST(ts AS DATE) BETWEEN w.first_day AND w.day,
        LATERAL (SELECT unnest(['global', event_type]) AS scope) s
      GROUP BY ALL""",
    "board": f"""
      SELECT capture_date, CAST({PERIOD_NO} AS BIGINT) * 1099511627776 + {SCOPE_NO} AS page_no, scope, period,
        '{P.SITE}{P.BOARD_PATH}/' || scope || '?since=' || period AS source_url,
        CASE WHEN scope = 'error' AND period = 'daily' THEN 'failed' ELSE 'success' END AS status,
        rank, item, {name('item')} AS full_name, '{P.SITE}/' || {name('item')} AS url,
        {name('item')} || ' in ' || scope || ' ' || period AS description,
        CASE WHEN scope <> 'global' THEN scope END AS primary_language,
        metric * 3 + rank AS total_stars, hits AS total_forks,
        CASE WHEN metric % 7 <> 0 THEN metric END AS period_stars
      FROM (SELECT *, CAST(row_number() OVER (PARTITION BY capture_date, scope, period ORDER BY metric DESC, item) AS INTEGER) AS rank
        FROM totals) WHERE rank <= {TOP}""",
    "altered": """
      SELECT * REPLACE (CASE WHEN item % 11 = 3 THEN 0 ELSE rank END AS rank, CASE WHEN item % 13 = 5 THEN 'http://mirror/' || full_name ELSE url END AS url,
          CASE WHEN item % 17 = 2 THEN -1 ELSE period_stars END AS period_stars),
        CASE WHEN scope = 'view' THEN 'yesterday' ELSE CAST(capture_date AS VARCHAR) || 'T09:00:00+08:00' END AS captured_at,
        left(sha256(source_url || CAST(capture_date AS VARCHAR)), CASE WHEN scope = 'click' THEN 60 ELSE 64 END) AS raw_sha256,
        CASE WHEN item % 19 <> 4 THEN ['u' || item] END AS built_by FROM board""",
    "good": "SELECT * FROM board WHERE status = 'success'",
    "board_pages": "SELECT DISTINCT capture_date, page_no, scope, period, source_url, status FROM board",
    "enriched": f"""
      SELECT *, list_sum(q) AS q_sum, CAST(list_sum(q) + CASE WHEN k % 31 = 0 THEN 1 ELSE 0 END AS INTEGER) AS quality_total,
        CAST(list_sum(v) AS INTEGER) AS value_total, {gate_cases()} AS gate_failures,
        CASE WHEN k % 67 = 5 THEN [] ELSE [good_url || '/src', good_url] END AS q_urls,
        CASE WHEN k % 71 = 3 THEN ['http://mirror/x'] ELSE [good_url] END AS v_urls,
        [good_url || '/blob/main/LICENSE'] AS l_urls, [good_url, good_url || '/README.md'] AS e_urls
      FROM (SELECT c_custkey AS k, {name('c_custkey')} AS full_name, '{P.SITE}/' || {name('c_custkey')} AS good_url,
        CASE WHEN c_custkey % 73 = 11 THEN 'http://mirror/' || {name('c_custkey')} ELSE '{P.SITE}/' || {name('c_custkey')} END AS url,
        CASE WHEN c_custkey % 61 = 1 THEN '' ELSE c_mktsegment END AS category,
        CASE WHEN c_custkey % 10 <> 3 THEN n_name END AS language,
        DATE '2024-01-20' - CAST((c_custkey * 7) % 180 AS INTEGER) - CASE WHEN c_custkey % 3 = 1 THEN 1 ELSE 0 END AS created_day,
        c_custkey % 17 = 3 AS is_fork, c_custkey % 19 = 4 AS is_mirror, c_custkey % 23 = 6 AS archived,
        {component_list('c_custkey', P.QUALITY_LIMITS, 5, True)} AS q, {component_list('c_custkey', P.VALUE_LIMITS, 3, False)} AS v,
        CASE WHEN c_custkey % 59 = 2 THEN '' ELSE 'L' || (c_custkey % 4) END AS license_name,
        CASE WHEN c_custkey % 43 = 8 THEN 'plain' ELSE 'usage à tous' END AS license_scope,
        CASE WHEN c_custkey % 41 = 0 THEN 'P9' ELSE 'P' || (c_custkey % 5) END AS value_level
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        WHERE c_custkey IN (SELECT user_id FROM events))""",
    "enriched_texts": """
      SELECT *, CAST(DATE '2024-01-20' - CAST((k * 7) % 180 AS INTEGER) AS VARCHAR) ||
          CASE k % 3 WHEN 0 THEN 'T00:30:00Z' WHEN 1 THEN 'T00:30:00+08:00' ELSE 'T10:00:00' END AS created_at,
        CASE WHEN k % 53 = 9 THEN 'not-a-time' ELSE '2024-01-29T00:00:00Z' END AS pushed_at,
        CASE WHEN k % 37 = 0 THEN '' ELSE 'static evidence ' || k END AS quality_rationale FROM enriched""",
    "enriched_early": f"SELECT * EXCLUDE (gate_failures), {gate_cases('k % 3 = 1')} AS gate_failures FROM enriched",
    "measures_now": measures_view(C),
    "measures_early": measures_view(B),
    **{f"{p}_rank_{tag}": rank_view(tag, p) for tag in ("now", "early") for p in P.PERIODS},
    "trend_now": trend_view("now"),
    "trend_early": trend_view("early"),
    "eval_now": evaluation_view(C, "now", "enriched"),
    "eval_early": evaluation_view(B, "early", "enriched_early"),
    "evals": "SELECT * FROM eval_now UNION ALL BY NAME SELECT * FROM eval_early",
    "accepted": """
      SELECT full_name, url, category, language,
        CASE WHEN age <= 90 THEN 'NEW_HOT' ELSE 'REVIVED_HOT' END AS hot_type, trend_score,
        quality_total AS quality_score, value_total AS value_score, value_level, primary_period, license_name, license_scope,
        final_score, grade, 'Résumé ' || k AS one_line, 'repos/' || replace(full_name, '/', '__') || '.md' AS card, capture_date
      FROM evals WHERE status = 'accepted'""",
    "catalog": """
      SELECT * EXCLUDE (capture_date, n, first_day), first_day AS first_accepted, capture_date AS last_evaluated
      FROM (SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY capture_date DESC) AS n,
        min(capture_date) OVER (PARTITION BY full_name) AS first_day FROM accepted) WHERE n = 1""",
    "fresh": f"""
      SELECT * FROM eval_now WHERE status = 'accepted'
        AND full_name IN (SELECT full_name FROM catalog WHERE first_accepted = {C})""",
    "features": f"""
      SELECT {C} AS capture_date, primary_period AS period, position, full_name, final_score FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY primary_period ORDER BY final_score DESC, lower(full_name), full_name) AS INTEGER)
          AS position FROM fresh) WHERE position <= {P.FEATURES_PER_PERIOD}""",
    "records": f"""
      SELECT *, sha256(content || CASE WHEN event_id % 19 = 6 THEN 'x' ELSE '' END) AS sha256,
        CASE WHEN event_id % 5 <> 0 THEN cached_day - CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END END AS fetched_on
      FROM (SELECT event_id, ts, {name('user_id')} AS full_name,
        CASE WHEN event_id % 29 = 3 THEN 'other/item' ELSE {name('user_id')} END AS manifest_name, CAST(ts AS DATE) AS cached_day,
        event_type AS kind, '{P.API_SITE}/' || {name('user_id')} || '/' || event_type || CASE WHEN event_id % 13 = 5 THEN '?old' ELSE '' END AS url,
        CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
        CASE WHEN event_id % 17 = 4 THEN '{{bad' ELSE props END AS content FROM events)""",
    "reuse": f"""
      SELECT r.full_name, r.kind, '{P.API_SITE}/' || r.full_name || '/' || r.kind AS url, hit IS NOT NULL AS reused,
        hit.sha256 AS sha256, hit.fetched_on AS fetched_on
      FROM (SELECT full_name, unnest({sql_list(KINDS)}) AS kind FROM (SELECT DISTINCT full_name FROM good WHERE capture_date = {C})) r
      LEFT JOIN (SELECT full_name, kind, url, max_by({{'sha256': sha256, 'fetched_on': coalesce(fetched_on, cached_day)}}, cached_day) AS hit
        FROM records JOIN (SELECT full_name, cached_day FROM records WHERE cached_day BETWEEN {C} - 1 AND {C} GROUP BY ALL
            HAVING count(*) = count(DISTINCT kind) AND bool_and(manifest_name = full_name)) sound USING (full_name, cached_day)
        WHERE status = 'success' AND coalesce(fetched_on, cached_day) BETWEEN {C} - 1 AND {C}
          AND sha256(content) = sha256 AND json_valid(content) GROUP BY ALL) h
        ON h.full_name = r.full_name AND h.kind = r.kind AND h.url = '{P.API_SITE}/' || r.full_name || '/' || r.kind""",
    "md_docs": f"""
      SELECT doc_id, lang, source, text, {MD} AS md
      FROM (SELECT *, doc_id AS k, split_part(text, {N}, 1) AS first FROM documents)""",
    "local_docs": f"""
      SELECT *, strlen(md) + CASE WHEN k % 53 = 10 THEN 1 ELSE 0 END AS source_bytes,
        'readmes/sources/' || source_sha256 || '.md' AS source_artifact,
        'readmes/' || replace(full_name, '/', '__') || '.zh-CN.md' AS translation,
        CASE WHEN k % 59 = 11 THEN '0' ELSE sha256(document) END AS translation_sha256,
        strlen(body) + CASE WHEN k % 61 = 12 THEN 1 ELSE 0 END AS translation_bytes
      FROM (SELECT *, '---' || {N} || 'full_name: ' || full_name || {N} || 'source_url: ' || source_url || {N} || 'source_sha256: '
          || CASE WHEN k % 47 = 9 THEN 'zz' ELSE source_sha256 END || {N} || 'language: '
          || CASE WHEN k % 41 = 7 THEN 'en' ELSE 'zh-CN' END
          || CASE WHEN k % 43 = 8 THEN '' ELSE {N} || 'mode: ' || mode END || {N} || '---' || {N} || {N} || body AS document
        FROM (SELECT doc_id, doc_id AS k, md, {name('doc_id', 'doc')} AS full_name, sha256(md) AS source_sha256,
          '{P.SITE}/' || {name('doc_id', 'doc')} || '/blob/main/README.md' AS source_url,
          CASE WHEN doc_id % 4 = 1 THEN '{P.MODE_COPY}' ELSE '{P.MODE_TRANSLATION}' END AS mode,
          CASE WHEN doc_id % 19 = 2 THEN replace(plain, '## Usage', 'Usage')
            WHEN doc_id % 23 = 3 THEN replace(plain, 'run --id', 'exec --id')
            WHEN doc_id % 29 = 4 THEN '# Extra' || {N} || {N} || plain
            WHEN doc_id % 31 = 5 THEN '# T' WHEN doc_id % 37 = 6 THEN '# Same' || {N} || {N} || 'é same body'
            ELSE plain END AS body
          FROM (SELECT *, {sub('md', STRIP)} AS plain FROM md_docs)))""",
    "manifest": f"""
      SELECT 'docs/' || (doc_id + CASE WHEN doc_id % 50 = 9 THEN 1000000000 ELSE 0 END) || '.md' AS path,
        sha256(text || CASE WHEN doc_id % 10 = 7 THEN '!' ELSE '' END) AS sha256, strlen(text) AS bytes, doc_id FROM documents""",
    "files": "SELECT 'docs/' || doc_id || '.md' AS path, sha256(text) AS sha256, strlen(text) AS bytes FROM documents",
    "by_hash": "SELECT sha256, max(path) AS source_path, max(bytes) AS actual_bytes FROM files GROUP BY sha256",
    "lines": f"SELECT doc_id, text, string_split(text, {N}) AS lines FROM documents",
    "linted": "SELECT doc_id, lines, {lint} AS violations FROM lines",
    "prints": f"SELECT doc_id, sha256(array_to_string(list_transform(lines, lambda x: lower(trim({sub('x', r'\s+', ' ')}))), {N})) AS fingerprint, sha256(lower(trim({sub('lines[1]', r'\s+', ' ')}))) AS first_print FROM lines",
    "print_groups": "SELECT fingerprint, count(*) AS members, min(doc_id) AS first_member FROM prints GROUP BY 1 HAVING count(*) > 1",
    "editions": f"""
      SELECT date, CASE WHEN day(date) % 10 = 3 THEN 2 ELSE 1 END AS schema_version,
        CASE WHEN day(date) % 10 = 6 THEN false ELSE true END AS periods_ok, d, w, m,
        CASE WHEN day(date) % 10 = 8 THEN list_reverse(d || w || m) ELSE d || w || m END AS displayed
      FROM (SELECT date, coalesce(list(name ORDER BY n) FILTER (scope = 'click'), []) AS d,
          coalesce(list(name ORDER BY n) FILTER (scope = 'purchase'), []) AS w, coalesce(list(name ORDER BY n) FILTER (scope = 'view'), []) AS m
        FROM (SELECT date, scope, {name('item')} AS name, row_number() OVER (PARTITION BY date, scope ORDER BY mm DESC, item) AS n
          FROM (SELECT CAST(ts AS DATE) AS date, event_type AS scope, user_id AS item, sum(CAST(round(value * 100) AS BIGINT)) AS mm
            FROM events GROUP BY ALL)) WHERE n <= {P.FEATURES_PER_PERIOD} GROUP BY date)""",
    "shown": "SELECT DISTINCT unnest(displayed) AS full_name FROM editions",
}


def contains_phrase(items: str, phrases) -> str:
    test = " OR ".join(f"contains(x, {quote(p)})" for p in phrases)
    return f"len(list_filter({items}, lambda x: {test})) > 0"


def lint_pairs() -> list[tuple[str, str]]:
    out = []
    for field, items in (("first", "[lines[1]]"), ("body", "lines")):
        out.append((f"len({items}) = 0 OR len(list_filter({items}, lambda x: trim(x) = '')) > 0", f"{field}_empty"))
        if field in Q.LINT_MIN_ITEMS:
            out.append((f"len({items}) < {Q.LINT_MIN_ITEMS[field]}", f"{field}_items"))
        out.append((contains_phrase(items, Q.FORBIDDEN_WORDS[field]), f"{field}_phrase"))
        for n, pattern in enumerate(Q.FORBIDDEN_SHAPES[field], 1):
            out.append((f"len(list_filter({items}, lambda x: {hits('x', '(?i)' + pattern)})) > 0", f"{field}_pattern_{n}"))
    return out


VIEWS["linted"] = f"SELECT doc_id, lines, {violations(*lint_pairs())} AS violations FROM lines"


def sql(statement: str) -> str:
    """``statement`` with the views it needs, directly or through others, in front."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for view, body in VIEWS.items():
            if view not in needed and re.search(rf"\b(?:FROM|JOIN|IN|,)\s*\(?\s*{view}\b", text):
                visit(body)
                if view not in needed:
                    needed.append(view)

    visit(statement)
    ctes = ",\n".join(f"{view} AS ({VIEWS[view]})" for view in needed)
    return (f"WITH {ctes}\n" if ctes else "") + statement


def unescape(x: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = f"replace({x}, {quote(entity)}, {quote(char)})"
    return x


NAV = r'<li><a href="/([^"]*)">([^<]*)</a></li>'

VIEWS["nav"] = f"""
      SELECT page_id, regexp_extract_all(html, {quote(NAV)}, 1) AS items, regexp_extract_all(html, {quote(NAV)}, 2) AS texts,
        regexp_extract(html, '<a href="/([^"]*)"', 1) AS slug FROM pages"""
VIEWS["board_outcomes"] = """
      SELECT *, CASE WHEN page_id % 10 = 8 THEN NULL WHEN page_id % 10 = 9 OR len(items) = 0 THEN 'unrecognized_page'
        WHEN page_id % 20 = 3 THEN 'unended_row' WHEN page_id % 10 = 7 THEN 'row_without_link'
        WHEN len(list_filter(items, lambda x: x = '' OR contains(x, '/'))) > 0 THEN 'invalid_row_key' END AS error FROM nav"""
VIEWS["board_items"] = f"""
      SELECT page_id, CAST(rank AS INTEGER) AS rank, {unescape('items[rank]')} AS item, {unescape('trim(texts[rank])')} AS shown
      FROM (SELECT *, unnest(range(1, len(items) + 1)) AS rank FROM board_outcomes WHERE error IS NULL AND page_id % 10 <> 8)"""
VIEWS["site_links"] = f"""
      SELECT DISTINCT page_id, page, href, regexp_extract(href, '^([^?#]*)', 1) AS path_part,
        CASE WHEN starts_with(href, '/') THEN regexp_extract(href, '^([^?#]*)', 1)
          WHEN starts_with(href, '../') THEN substr(regexp_extract(href, '^([^?#]*)', 1), 4)
          ELSE 'repos/' || regexp_extract(href, '^([^?#]*)', 1) END AS target
      FROM (SELECT page_id, 'repos/' || slug || '.html' AS page, CASE page_id % 3 WHEN 0 THEN {unescape('x')} || '.html'
          WHEN 1 THEN '../repos/' || {unescape('x')} || '.html?v=1#top' ELSE '/' || {unescape('x')} END AS href
        FROM (SELECT page_id, slug, unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS x FROM pages JOIN nav USING (page_id))
        WHERE page_id % 6 <> 5) WHERE regexp_extract(href, '^([^?#]*)', 1) <> ''"""
VIEWS["page_numbers"] = "SELECT *, row_number() OVER (PARTITION BY capture_date ORDER BY page_no) - 1 AS page FROM board_pages"
VIEWS["site_targets"] = "SELECT DISTINCT 'repos/' || slug || '.html' AS target FROM nav UNION SELECT 'repos'"
VIEWS["link_docs"] = f"""
      SELECT doc_id, {name('doc_id', 'doc')} AS full_name, CASE WHEN doc_id % 4 = 1 THEN 'docs/guide/' ELSE '' END AS dir, lang, md,
        '{P.RAW_SITE}/' || {name('doc_id', 'doc')} || CASE WHEN doc_id % 2 = 0 THEN '/main/' ELSE '/feature%2Fx/' END AS raw,
        '{P.SITE}/' || {name('doc_id', 'doc')} || '/blob' || CASE WHEN doc_id % 2 = 0 THEN '/main/' ELSE '/feature%2Fx/' END AS blob
      FROM md_docs"""
DOTTED = "CASE WHEN dir = '' THEN 'docs/' ELSE 'docs/docs/' END || lang || '.md#top'"
CLOSED_DAY = "CAST(ts AS DATE) + 1 <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)"
SNAPSHOT_DAY = f"{C} - 2"


def localized_rules() -> list[tuple[str, str]]:
    """What a document breaks by itself."""
    present = "has AND fm"
    header = [
        ("NOT has", "file_missing"),
        ("has AND NOT fm", "frontmatter"),
        ("has AND lower(translation_sha256) <> sha256(document)", "translation_sha256"),
        ("has AND k % 47 = 9", "source_sha256"),
        ("has AND k % 47 = 9", "source_sha256_shape"),
        ("has AND k % 41 = 7", "language"),
        ("k % 71 = 14", "source_changed"),
        ("source_bytes <> strlen(src)", "source_bytes"),
    ]
    content = structure_rules("mode", "body", "src") + prose_rules("mode", "body", "src") + length_rules("mode", "body")
    return header + [(f"{present} AND ({condition})", rule) for condition, rule in content]


VIEWS["local_rows"] = """
      SELECT *, k % 67 <> 13 AS has, k % 43 <> 8 AS fm, md || CASE WHEN k % 71 = 14 THEN 'x' ELSE '' END AS src FROM local_docs"""
VIEWS["listed_rows"] = """
      SELECT r.* FROM local_rows r, LATERAL (SELECT unnest(range(CASE WHEN k % 83 = 15 THEN 2 ELSE 1 END))) WHERE k % 79 <> 18"""


def localized_statement() -> str:
    repeated = ("has AND count(*) FILTER (has) OVER (PARTITION BY body) > 1", "repeated_body")
    return f"SELECT full_name, {violations(*localized_rules(), repeated)} AS violations FROM local_rows"


def report_statement() -> str:
    first = f"split_part(text, {N}, 1)"
    sections = [f"CASE WHEN doc_id % 7 = {i} THEN '' ELSE {quote(f'## {name}')} || {N} || {N} || {first} END" for i, name in enumerate(P.REQUIRED_REPORT_SECTIONS)]
    phrases = [f"CASE WHEN doc_id % {11 + 2 * i} = 3 THEN {quote(p)} ELSE '' END" for i, p in enumerate(P.FORBIDDEN_REPORT_PHRASES)]
    missing = violations(*[(f"NOT contains(report, {quote(p)})", p) for p in P.REQUIRED_REPORT_SECTIONS])
    present = violations(*[(f"contains(report, {quote(p)})", p) for p in P.FORBIDDEN_REPORT_PHRASES])
    return f"""
      SELECT *, missing_sections = '' AND forbidden_sections = '' AS valid FROM (
        SELECT doc_id, {missing} AS missing_sections, {present} AS forbidden_sections
        FROM (SELECT doc_id, {f" || {N} || ".join(sections + phrases)} AS report FROM documents))"""


def collection_statement() -> str:
    names = violations(
        ("entries > 1", "repeated_name"), ("shown AND entries = 0", "entry_missing"), ("NOT shown AND entries > 0", "not_displayed"),
        ("shown AND k % 73 = 21", "not_in_catalog"),
    )
    return f"""
      SELECT * FROM (
        SELECT 'document' AS "check", full_name AS item, {violations(*localized_rules())} AS violations FROM listed_rows
        UNION ALL SELECT 'name', full_name, {names}
        FROM (SELECT *, k % 89 <> 16 AS shown, (SELECT count(*) FROM listed_rows l WHERE l.full_name = d.full_name) AS entries FROM local_docs d)
        UNION ALL SELECT 'file', translation, CASE WHEN k % 67 = 13 THEN CASE WHEN k % 79 <> 18 THEN 'file_missing' ELSE '' END WHEN k % 79 = 18 THEN 'file_extra' ELSE '' END FROM local_docs
        UNION ALL SELECT 'file', 'readmes/stray-' || k || '.zh-CN.md', 'file_extra' FROM local_docs WHERE k % 97 = 17
        UNION ALL SELECT 'body', sha256(body), CASE WHEN count(*) > 1 THEN 'repeated_body' ELSE '' END FROM listed_rows WHERE has GROUP BY body
        UNION ALL SELECT 'manifest', 'entry_count', CASE WHEN count(*) <> (SELECT count(*) FROM documents) THEN 'entry_count' ELSE '' END FROM listed_rows
        UNION ALL SELECT 'manifest', 'schema_version', 'schema_version'
      ) WHERE violations <> ''"""


def rendered_statement() -> str:
    kept = "k % 15 <> 5"
    content = (
        "CASE WHEN k % 8 = 1 THEN " + sub("body", "<video[^>]*></video>")
        + " WHEN k % 8 = 2 THEN replace(body, '<details>', '&lt;details>') ELSE body END"
    )
    rules = [("k % 15 = 5", "section_missing"), (f"{kept} AND k % 13 = 4", "stale_source"), (f"{kept} AND k % 9 = 3", "rendered_changed")]
    for tag in P.MEDIA_TAGS:
        rules.append((f"{kept} AND list_contains(tags, '{tag}') AND NOT {hits('content', f'(?i)<{tag}' + chr(92) + 'b')} AND '{tag}' <> 'img'", f"dropped_{tag}"))
        rules.append((f"{kept} AND contains(lower(content), '&lt;{tag}')", f"escaped_{tag}"))
    return f"""
      SELECT full_name, {violations(*rules)} AS violations FROM (SELECT *, {content} AS content, {media('body')} AS tags FROM local_docs)"""


def tree_levels(leaf: int, fanout: int, most: int = 8) -> str:
    """The nodes of a digest tree over ``files``, as a subquery."""
    parts = [
        "l0 AS (SELECT row_number() OVER (ORDER BY string_split(path, '/'), path) AS pos, path AS key, lower(hex(encode(path))) || sha256 AS hex, 1 AS files, NULL AS own FROM files)"
    ]
    nodes = []
    for level in range(most):
        each, salt = (leaf, "") if level == 0 else (fanout, f" || '#{level}'")
        parts.append(f"""
      s{level} AS (SELECT *, (SELECT count(*) FROM l{level}) > {each} AND CAST('0x' || left(sha256(key{salt}), 8) AS BIGINT) % {each} = 0 AS starts FROM l{level}),
      b{level} AS (SELECT *, coalesce(max(CASE WHEN starts THEN pos END) OVER (ORDER BY pos), 1) AS first FROM s{level}),
      r{level} AS (SELECT *, first + (pos - first) // {T.LONGEST * each} * {T.LONGEST * each} AS run FROM b{level}),
      n{level} AS (SELECT run, min_by(key, pos) AS key, CAST(sum(files) AS BIGINT) AS files, sha256(unhex(string_agg(hex, '' ORDER BY pos))) AS digest FROM r{level} GROUP BY run),
      l{level + 1} AS (SELECT row_number() OVER (ORDER BY run) AS pos, key, digest AS hex, files, run AS own FROM n{level} WHERE (SELECT count(*) FROM n{level}) > 1)""")
        parent = f"(SELECT n.key FROM r{level + 1} r JOIN n{level + 1} n ON n.run = r.run WHERE r.own = n{level}.run)" if level + 1 < most else "NULL"
        nodes.append(f"SELECT {level} AS level, key, {parent} AS parent, files, digest FROM n{level}")
    # a level of one leaf or node has no rows above it
    return f"(WITH {','.join(parts)} {' UNION ALL '.join(nodes)})"


#: No evidence at all, or some that lies elsewhere.
FOREIGN_EVIDENCE = f"len(e_urls || l_urls || q_urls || v_urls) = 0 OR len(list_filter(e_urls || l_urls || q_urls || v_urls, lambda u: NOT starts_with(u, '{P.SITE}/'))) > 0"

STATEMENTS = {
    "board_matrix": f"""
      SELECT CAST({PERIOD_NO} AS BIGINT) * 1099511627776 + {SCOPE_NO} AS page_no, scope, period,
        '{P.SITE}{P.BOARD_PATH}' || CASE WHEN scope = 'global' THEN '' ELSE '/' || scope END || '?since=' || period || '&spoken_language_code=' AS url,
        scope || '-' || period AS slug
      FROM (SELECT DISTINCT unnest([event_type, 'global']) AS scope FROM events), (SELECT unnest({sql_list(P.PERIODS)}) AS period)""",
    "board_entries": "SELECT capture_date, scope, period, rank, full_name, period_stars, total_stars, total_forks FROM board",
    "success_pages_only": "SELECT capture_date, scope, period, count(*) AS entries, max(rank) AS last_rank FROM good GROUP BY ALL",
    "page_hash_manifest": "SELECT page_id, sha256(html) AS sha256, CAST(strlen(html) AS INTEGER) AS bytes FROM pages",
    "consolidate": """
      SELECT capture_date, full_name, s.url AS url, s.description AS description, s.primary_language AS primary_language,
        total_stars, total_forks, appearance_count FROM (
        SELECT capture_date, full_name,
          min_by({'url': url, 'description': description, 'primary_language': primary_language}, page_no * 1000 + rank) AS s,
          max(total_stars) AS total_stars, max(total_forks) AS total_forks, count(*) AS appearance_count
        FROM good GROUP BY ALL)""",
    "appearances": """
      SELECT capture_date, full_name, page_no, scope, period, rank, period_stars, source_url,
        sha256(source_url || CAST(capture_date AS VARCHAR)) AS raw_sha256 FROM good""",
    "average_rank": f"SELECT capture_date, full_name, {round2('avg(rank)')} AS average_rank FROM good GROUP BY ALL",
    "period_max_pivot": "SELECT capture_date, full_name, "
    + ", ".join(f"max(period_stars) FILTER (period = '{p}') AS {p}_stars" for p in P.PERIODS)
    + " FROM good GROUP BY ALL",
    "cross_period": f"""
      SELECT capture_date, full_name, {round2('count(DISTINCT period) * 100.0 / 3')} AS cross_period, count(*) AS appearance_count,
        array_to_string(list_sort(list_distinct(list(period))), ',') AS periods_present FROM good GROUP BY ALL""",
    "distinct_candidates": "SELECT DISTINCT full_name FROM good",
    "name_order": "SELECT full_name, row_number() OVER (ORDER BY lower(full_name), full_name) AS position FROM (SELECT DISTINCT full_name FROM good)",
    "collection_summary": f"""
      SELECT * FROM (SELECT count(*) AS page_count, count(*) FILTER (status = 'success') AS successful_pages,
          count(*) FILTER (status <> 'success') AS failures FROM board_pages WHERE capture_date = {C}),
        (SELECT count(DISTINCT full_name) AS candidate_count FROM good WHERE capture_date = {C}),
        (SELECT count(*) FILTER (reused) AS cache_hits, count(*) FILTER (NOT reused) AS evidence_fetches,
          count(*) FILTER (NOT reused AND kind = 'view' AND full_name LIKE '%7') AS evidence_failures FROM reuse)""",
    "previous_snapshot": f"""
      SELECT capture_date, scope, period, rank, full_name FROM board
      WHERE capture_date = (SELECT max(capture_date) FROM board WHERE capture_date < {C})""",
    "momentum_join": f"""
      SELECT full_name, {round2('now_rank')} AS current_rank, {round2('before_rank')} AS previous_rank,
        CASE WHEN before_rank IS NULL THEN 50.0
          ELSE {round2('greatest(0.0, least(100.0, 50.0 + (before_rank - now_rank) * 5.0))')} END AS rank_momentum
      FROM (SELECT full_name, avg(rank) FILTER (capture_date = {C}) AS now_rank, avg(rank) FILTER (capture_date = {B}) AS b
        FROM good GROUP BY ALL) a(full_name, now_rank, before_rank) WHERE now_rank IS NOT NULL""",
    "rank_momentum": "SELECT full_name, average_rank, previous_average_rank, rank_momentum FROM trend_now",
    "midrank_percentile": f"""
      SELECT scope, item, metric, {round2('''CASE WHEN metric IS NULL OR k < 2 THEN 50.0 ELSE 100.0 * (less + (equal - 1) / 2) / (k - 1) END''')} AS percentile
      FROM (SELECT *, count(metric) OVER (PARTITION BY scope) AS k,
          rank() OVER (PARTITION BY scope, metric IS NULL ORDER BY metric) - 1 AS less,
          count(*) OVER (PARTITION BY scope, metric) AS equal
        FROM (SELECT event_type AS scope, user_id AS item,
          CASE WHEN user_id % 9 <> 4 THEN CAST(sum(CAST(round(value * 100) AS BIGINT)) // 5000 AS BIGINT) END AS metric FROM events GROUP BY event_type, user_id))""",
    "trend_score": f"SELECT full_name, {', '.join(P.TREND_WEIGHTS)}, trend_score, trend_pass FROM trend_now",
    "trend_board": "SELECT * FROM trend_now",
    "hard_filter": "SELECT full_name, gate_failures, gate_failures = '' AS gate_pass FROM enriched",
    "primary_period": f"SELECT full_name, primary_period FROM ({evaluation_view(C, 'now', '(SELECT full_name, 0 AS quality_total, 0 AS value_total, NULL::VARCHAR AS gate_failures, NULL::DATE AS created_day FROM trend_now)')})",
    "candidate_enrichment": "SELECT full_name, category, language, trend_score, quality_total AS quality_score FROM enriched JOIN trend_now USING (full_name)",
    "final_score": "SELECT full_name, final_score FROM eval_now",
    "grade": "SELECT capture_date, full_name, final_score, grade FROM evals",
    "evaluate_waterfall": "SELECT capture_date, full_name, trend_score, final_score, grade, status, rejection_stage, rejection_reasons FROM evals",
    "evidence_union": "SELECT full_name, array_to_string(list_sort(list_distinct(e_urls || l_urls || q_urls || v_urls)), ',') AS evidence_urls FROM enriched",
    "component_total": f"""
      SELECT full_name, 'quality' AS block, CAST(q_sum AS BIGINT) AS component_total, {in_limits('q', P.QUALITY_LIMITS)} AS in_range,
        q_sum = quality_total AS total_matches FROM enriched
      UNION ALL SELECT full_name, 'value', CAST(value_total AS BIGINT), {in_limits('v', P.VALUE_LIMITS)}, true FROM enriched""",
    "catalog_upsert": "SELECT * FROM catalog",
    "stream_catalog_upsert": "SELECT * FROM catalog",
    "first_accepted": "SELECT full_name, min(capture_date) AS first_accepted FROM accepted GROUP BY 1",
    "newly_accepted": "SELECT full_name, final_score FROM fresh",
    "catalog_order": "SELECT row_number() OVER (ORDER BY final_score DESC, lower(full_name), full_name) AS position, full_name, final_score FROM catalog",
    "accepted_order": "SELECT full_name, final_score, grade, row_number() OVER (ORDER BY final_score DESC, full_name) AS position FROM eval_now WHERE status = 'accepted'",
    "per_period_index": """
      SELECT primary_period AS period, row_number() OVER (PARTITION BY primary_period ORDER BY final_score DESC, lower(full_name), full_name) AS position,
        full_name, grade, final_score, trend_score, quality_score, value_score FROM catalog""",
    "catalog_search": """
      SELECT c_name, c_mktsegment AS category, n_name AS language FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
      WHERE c_mktsegment = 'MACHINERY' AND contains(lower(c_name || ' ' || c_mktsegment || ' ' || coalesce(n_name, '')), 'customer')
        AND contains(lower(c_name || ' ' || c_mktsegment || ' ' || coalesce(n_name, '')), 'machin')
        AND contains(lower(c_name || ' ' || c_mktsegment || ' ' || coalesce(n_name, '')), '1')""",
    "facets": f"""
      SELECT facet, value, count(*) AS entries FROM (
        SELECT 'category' AS facet, coalesce(nullif(category, ''), '{P.LABEL_UNCATEGORIZED}') AS value FROM catalog
        UNION ALL SELECT 'language', coalesce(nullif(language, ''), '{P.LABEL_NO_LANGUAGE}') FROM catalog) GROUP BY ALL""",
    "latest_attribute": f"""
      SELECT {name('user_id')} AS full_name, max_by(coalesce(nullif(t, 'signup'), '{P.LABEL_NO_LANGUAGE}'), day) AS language, max(day) AS capture_date
      FROM (SELECT user_id, CAST(ts AS DATE) AS day, max(event_type) AS t FROM events GROUP BY ALL) GROUP BY 1""",
    "detail_join": f"""
      SELECT full_name, category, language, summary, full_name || ' ' || summary || ' ' || category || ' ' || language AS search, last_evaluated
      FROM (SELECT c.full_name, coalesce(nullif(c.category, ''), '{P.LABEL_UNCATEGORIZED}') AS category,
          coalesce(upper(e.language), nullif(c.language, ''), '{P.LABEL_NO_LANGUAGE}') AS language,
          coalesce(nullif(d.line, ''), c.one_line, '') AS summary, c.last_evaluated
        FROM catalog c LEFT JOIN (SELECT {name('doc_id')} AS full_name, {sub(f"split_part({section('md', 'Summary')}, {N} || {N}, 1)", STRIP)} AS line FROM md_docs) d USING (full_name)
        LEFT JOIN enriched e USING (full_name))""",
    "normalized_projection": "SELECT capture_date, full_name, grade, trend_score, quality_total AS quality_score, value_total AS value_score, final_score FROM evals",
    "history_desc": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS capture_date, CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) AS latest FROM orders",
    "period_features": "SELECT * FROM features",
    "edition_stats": f"""
      SELECT {C} AS capture_date, (SELECT count(*) FROM board_pages WHERE capture_date = {C}) AS pages,
        (SELECT count(*) FROM trend_now) AS raw_candidates, count(*) AS evaluated, count(*) FILTER (status = 'accepted') AS accepted,
        count(*) FILTER (status = 'rejected') AS rejected, (SELECT count(*) FROM fresh) AS newly_accepted,
        (SELECT count(*) FROM catalog) AS catalog_entries FROM eval_now""",
    "daily_edition": f"""
      SELECT {C} AS date, CAST(row_number() OVER (ORDER BY list_position({sql_list(P.PERIODS)}, period), position) AS INTEGER) AS display_no, period, full_name FROM features""",
    "daily_report": f"""
      SELECT f.capture_date, f.period, f.position, f.full_name, e.grade, e.trend_score, e.quality_total AS quality_score,
        e.value_total AS value_score, e.final_score,
        coalesce(CAST(CASE f.period WHEN 'daily' THEN daily_stars WHEN 'weekly' THEN weekly_stars ELSE monthly_stars END AS VARCHAR), '{P.LABEL_NOT_SHOWN}') AS period_stars
      FROM features f JOIN eval_now e USING (full_name)""",
    "edition_rules": "SELECT date, array_to_string(displayed, ',') AS displayed, "
    + violations(
        ("schema_version <> 1", "schema_version"),
        ("NOT periods_ok", "periods"),
        ("periods_ok AND len(list_distinct(d || w || m)) <> len(d || w || m)", "duplicate_feature"),
        ("NOT periods_ok OR displayed <> d || w || m", "displayed"),
    )
    + " AS violations FROM editions",
    "displayed_union": "SELECT * FROM shown",
    "coverage_subset": "SELECT full_name FROM shown WHERE full_name NOT IN (SELECT full_name FROM catalog)",
    "feature_lookup": f"""
      SELECT {C} AS capture_date, s.full_name, e.status, e.final_score AS evaluated_score, e.status IS NULL AS missing
      FROM shown s LEFT JOIN eval_now e USING (full_name)""",
    "page_rules": f"""
      SELECT capture_date, scope, period, full_name, violations, violations = '' AS valid FROM (
        SELECT *, {violations(
            (f"scope NOT IN ({', '.join(quote(x) for x in SCOPES[:-1])})", "scope"),
            (f"period NOT IN ({', '.join(quote(x) for x in P.PERIODS)})", "period"),
            ("status NOT IN ('success', 'failed')", "status"),
            ("try_cast(captured_at AS TIMESTAMPTZ) IS NULL", "captured_at"),
            (f"NOT {hits('raw_sha256', '^[A-Fa-f0-9]{64}$')}", "raw_sha256"),
            (f"NOT starts_with(source_url, '{P.SITE}{P.BOARD_PATH}')", "source_url"),
            ("status = 'failed' AND rank IS NOT NULL", "failed_page_has_rows"),
            ("rank < 1", "rank"),
            (f"url <> '{P.SITE}/' || full_name", "url"),
            ("coalesce(total_stars, -1) < 0", "total_stars"),
            ("coalesce(total_forks, -1) < 0", "total_forks"),
            ("period_stars < 0", "period_stars"),
            ("built_by IS NULL", "built_by"),
        )} AS violations FROM altered)""",
    "duplicate_ranks": "SELECT capture_date, scope, period, rank, count(*) AS rows FROM (SELECT * REPLACE (CAST(CASE WHEN item % 11 = 3 THEN 0 ELSE rank END AS INTEGER) AS rank) FROM board) GROUP BY ALL HAVING count(*) > 1",
    "matrix_coverage": f"""
      SELECT scope, period, coalesce(n, 0) AS pages, CASE WHEN w.scope IS NULL THEN 'unexpected' WHEN n IS NULL THEN 'missing' ELSE 'repeated' END AS outcome
      FROM (SELECT scope, period, count(*) AS n FROM board_pages WHERE scope <> 'view' GROUP BY ALL) a
      FULL JOIN (SELECT DISTINCT scope, period FROM (SELECT unnest([event_type, 'global']) AS scope FROM events), (SELECT unnest({sql_list(P.PERIODS)}) AS period) WHERE scope <> 'click') w USING (scope, period)
      WHERE w.scope IS NULL OR n IS NULL OR n > 1""",
    "expected_set_equality": f"""
      SELECT count(*) FILTER (a.scope IS NULL) AS missing, count(*) FILTER (w.scope IS NULL) AS extra, count(*) FILTER (a.scope IS NULL OR w.scope IS NULL) = 0 AS equal
      FROM (SELECT DISTINCT scope, period FROM board_pages WHERE status = 'success') a
      FULL JOIN (SELECT DISTINCT scope, period FROM (SELECT unnest([event_type, 'global']) AS scope FROM events), (SELECT unnest({sql_list(P.PERIODS)}) AS period)) w
        ON a.scope = w.scope AND a.period = w.period""",
    "duplicate_keys": "SELECT full_name, count(*) AS rows FROM (SELECT full_name FROM enriched UNION ALL SELECT DISTINCT full_name FROM good) GROUP BY 1 HAVING count(*) > 1",
    "pool_reconcile": """
      SELECT full_name, 'extra' AS side FROM enriched WHERE k % 40 <> 39 AND full_name NOT IN (SELECT full_name FROM good)
      UNION ALL SELECT DISTINCT full_name, 'missing' FROM good WHERE full_name NOT IN (SELECT full_name FROM enriched WHERE k % 40 <> 39)""",
    "pool_counts": f"SELECT raw_candidates, evaluated, raw_candidates = declared_raw AS raw_match, evaluated = declared AS evaluated_match FROM (SELECT (SELECT count(*) FROM trend_now) AS raw_candidates, (SELECT count(*) FROM enriched WHERE k % 40 <> 39) AS evaluated, (SELECT count(DISTINCT full_name) FROM board WHERE capture_date = {C}) AS declared_raw, (SELECT count(*) FROM enriched) AS declared)",
    "symmetric_difference": f"""
      SELECT full_name, 'extra' AS side FROM (SELECT full_name FROM board WHERE capture_date = {C} EXCEPT SELECT full_name FROM board WHERE capture_date = {B})
      UNION ALL SELECT full_name, 'missing' FROM (SELECT full_name FROM board WHERE capture_date = {B} EXCEPT SELECT full_name FROM board WHERE capture_date = {C})""",
    "enrichment_rules": f"""
      SELECT full_name, violations, violations = '' AS valid FROM (SELECT full_name, {violations(
          (f"url <> '{P.SITE}/' || full_name", "url"),
          ("try_cast(created_at AS TIMESTAMPTZ) IS NULL", "created_at"),
          ("try_cast(pushed_at AS TIMESTAMPTZ) IS NULL", "pushed_at"),
          ("is_fork IS NULL OR is_mirror IS NULL OR archived IS NULL", "state_flags"),
          ("coalesce(trim(license_name), '') = ''", "license_name"),
          (f"NOT {hits('license_scope', f'[{SCRIPT}]')}", "license_scope"),
          ("l_urls IS NULL", "license_evidence"),
          (f"NOT {in_limits('q', P.QUALITY_LIMITS)}", "quality_scores"),
          ("list_sum(q) <> quality_total", "quality_total"),
          ("trim(quality_rationale) = ''", "quality_rationale"),
          ("len(q_urls) = 0", "quality_evidence"),
          (f"NOT {in_limits('v', P.VALUE_LIMITS)}", "value_scores"),
          ("list_sum(v) <> value_total", "value_total"),
          (f"value_level NOT IN ({', '.join(quote(x) for x in P.VALUE_LEVELS)})", "value_level"),
          ("len(v_urls) = 0", "value_evidence"),
          (FOREIGN_EVIDENCE, "evidence_urls"),
      )} AS violations FROM enriched_texts)""",
    "evidence_url_rule": f"SELECT full_name, CAST(len(e_urls) + len(l_urls) + len(q_urls) + len(v_urls) AS INTEGER) AS url_count, NOT ({FOREIGN_EVIDENCE}) AS valid FROM enriched",
    "snapshot_counts": f"SELECT doc_id, CAST(len(string_split(text, {N})) + 1 AS INTEGER) AS declared, CAST(len(string_split(text, {N})) AS INTEGER) AS actual FROM documents WHERE doc_id % 5 = 2",
    "native_script_rule": f"SELECT doc_id, {hits('text', f'[{SCRIPT}]')} AND NOT {hits('text', f'[A-Za-z][{P.FOREIGN_RUN}]{{60,}}')} AS native FROM documents",
    "text_lint_rules": "SELECT doc_id, violations, violations = '' AS valid FROM linted",
    "section_rules": f"""
      SELECT doc_id, missing_sections, forbidden_sections, missing_sections = '' AND forbidden_sections = '' AS valid FROM (
        SELECT doc_id, {violations(*[(f"NOT contains(md, {quote(p)})", p) for p in Q.REQUIRED_PARTS])} AS missing_sections,
          {violations(*[(f"contains(md, {quote(p)})", p) for p in Q.FORBIDDEN_PARTS])} AS forbidden_sections FROM md_docs)""",
    "duplicate_fingerprints": "SELECT fingerprint, doc_id AS member, members, first_member FROM prints JOIN print_groups USING (fingerprint)",
    "audit_summary": """
      SELECT count(*) AS rows, count(*) FILTER (violations <> '' OR nf > 1 OR nb > 1) AS invalid_rows,
        count(DISTINCT first_print) FILTER (nf > 1) AS duplicate_first_sets, count(DISTINCT fingerprint) FILTER (nb > 1) AS duplicate_body_sets
      FROM (SELECT *, count(*) OVER (PARTITION BY first_print) AS nf, count(*) OVER (PARTITION BY fingerprint) AS nb FROM prints JOIN linted USING (doc_id))""",
    "content_audit": f"""
      SELECT doc_id, CAST(CASE WHEN violations = '' THEN 0 ELSE len(string_split(violations, ',')) END AS INTEGER) AS rule_failures,
        {hits('text', f'[{SCRIPT}]')} AND NOT {hits('text', f'[A-Za-z][{P.FOREIGN_RUN}]{{60,}}')} AS native,
        coalesce(members, 1) AS copies, violations = '' AND members IS NULL AS valid
      FROM documents JOIN linted USING (doc_id) JOIN prints USING (doc_id) LEFT JOIN print_groups USING (fingerprint)""",
    "issue_sample": "SELECT doc_id, violations, (SELECT count(*) FROM linted WHERE violations <> '') AS total FROM linted WHERE violations <> '' ORDER BY doc_id LIMIT 20",
    "evidence_asof_reuse": "SELECT * FROM reuse",
    "evidence_refresh": """
      SELECT full_name, kind, url, reused AND NOT anew AS reused, CASE WHEN NOT anew THEN sha256 END AS sha256, CASE WHEN NOT anew THEN fetched_on END AS fetched_on
      FROM (SELECT *, CAST(regexp_extract(full_name, '([0-9]+)$', 1) AS BIGINT) % 4 = 1 AS anew FROM reuse)""",
    "newest_per_kind": """
      SELECT full_name, kind, r.fetched_on AS fetched_on, r.sha256 AS sha256 FROM (
        SELECT full_name, kind, max({'fetched_on': coalesce(fetched_on, cached_day), 'sha256': sha256}) AS r FROM records WHERE status = 'success' GROUP BY ALL)""",
    "manifest_hash_verify": """
      SELECT path, m.sha256, f.sha256 AS actual_sha256, CASE WHEN f.sha256 IS NULL THEN 'missing' WHEN f.sha256 <> m.sha256 THEN 'changed' ELSE 'ok' END AS outcome
      FROM manifest m LEFT JOIN files f USING (path)""",
    "tree_fingerprint": f"SELECT files, digest AS fingerprint FROM {tree_levels(T.LEAF, T.FANOUT)} WHERE parent IS NULL",
    "digest_tree": f"SELECT level, key, parent, files, digest FROM {tree_levels(Q.SMALL_LEAF, Q.SMALL_FANOUT)}",
    "tree_diff": """
      SELECT path, CASE WHEN m.sha256 IS NULL THEN 'added' WHEN f.sha256 IS NULL THEN 'removed' ELSE 'changed' END AS outcome,
        m.sha256 AS sha256_before, f.sha256 AS sha256_after FROM manifest m FULL JOIN files f USING (path) WHERE m.sha256 IS DISTINCT FROM f.sha256""",
    "bind_sources": """
      SELECT m.path AS full_name, source_path, CASE WHEN actual_bytes = want THEN 'readmes/sources/' || m.sha256 || '.md' END AS source_artifact,
        CASE WHEN source_path IS NULL THEN 'missing' WHEN actual_bytes <> want THEN 'size_mismatch' ELSE 'bound' END AS outcome
      FROM (SELECT *, bytes + CASE WHEN doc_id % 9 = 4 THEN 1 ELSE 0 END AS want FROM manifest) m LEFT JOIN by_hash USING (sha256)""",
    "manifest_source_join": "SELECT m.path AS full_name, source_path, actual_bytes FROM manifest m JOIN by_hash USING (sha256)",
    "incremental_by_hash": f"""
      SELECT doc_id, sha256('{Q.RENDER_VERSION}' || {N} || text) AS content_key,
        length(text) % 5 <> 0 AND text IN (SELECT text FROM documents WHERE lang <> 'en') AS hit,
        sha256('<p>' || replace(replace(text, '&', '&amp;'), {N}, '<br>') || '</p>') AS output_sha256 FROM documents""",
    "incremental_summary": """
      SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) FILTER (NOT hit) AS misses, CAST(sum(n) - count(*) FILTER (NOT hit) AS BIGINT) AS hits
      FROM (SELECT text, count(*) AS n, length(text) % 5 <> 0 AND bool_or(lang <> 'en') AS hit FROM documents GROUP BY text)""",
    "set_equality_audit": """
      SELECT 'labels' AS audit, CAST(coalesce(l.doc_id, d.doc_id) AS VARCHAR) AS item, CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'extra' END AS side
      FROM labels l FULL JOIN documents d ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL OR d.doc_id IS NULL
      UNION ALL SELECT 'files', coalesce(f.path, m.path), CASE WHEN f.path IS NULL THEN 'missing' ELSE 'extra' END
      FROM files f FULL JOIN manifest m ON f.path = m.path WHERE f.path IS NULL OR m.path IS NULL""",
    "duplicate_bodies": """
      SELECT CAST(sum(n) AS BIGINT) AS documents, count(*) AS distinct_bodies, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS in_repeated_groups,
        sum(n) = count(*) AS "unique" FROM (SELECT text, count(*) AS n FROM documents GROUP BY 1)""",
    "stale_artifacts": "SELECT path FROM manifest WHERE path NOT IN (SELECT path FROM files)",
    "group_sizes": f"""
      SELECT 'run-' || day AS "group", day, count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS bytes, CAST(sum(strlen(text) - strlen(text) // 3) AS BIGINT) AS saved_bytes
      FROM (SELECT *, DATE '2024-01-01' + CAST(doc_id % 40 AS INTEGER) AS day FROM documents) WHERE doc_id % 12 <> 5 AND day < {C} GROUP BY day""",
    "manifest_audit": """
      SELECT CASE WHEN f.sha256 IS NULL THEN 'missing' WHEN f.sha256 <> m.sha256 THEN 'changed' ELSE 'ok' END AS finding, count(*) AS rows
      FROM manifest m LEFT JOIN files f USING (path) GROUP BY 1
      UNION ALL SELECT 'unlisted', count(*) FROM files WHERE path NOT IN (SELECT path FROM manifest)
      UNION ALL SELECT 'repeated_body', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)""",
    "active_references": """
      SELECT doc_id AS text_id, item_id AS target_id FROM documents d, benchmark b
      WHERE contains(lower(replace(d.text, chr(92), '/')), lower(replace(b.text, chr(92), '/')))""",
    "parse_compact_number": f"""
      SELECT c_custkey, shown, CASE WHEN shown = 'none' THEN 0 ELSE CAST(trunc(CAST(regexp_extract(shown, '[0-9]+\\.?[0-9]*') AS DOUBLE)
          * CASE WHEN c_custkey % 4 = 0 THEN 1000 WHEN c_custkey % 4 = 1 THEN 1000000 ELSE 1 END) AS BIGINT) END AS number
      FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 = 3 THEN 'none' ELSE CAST(CAST(c_acctbal AS DECIMAL(15,3)) AS VARCHAR)
        || CASE c_custkey % 4 WHEN 0 THEN 'k stars' WHEN 1 THEN ' M stars' WHEN 2 THEN ',' ELSE 'x' END END AS shown FROM customer)""",
    "canonical_url": f"SELECT c_custkey, '{P.SITE}/' || {name('c_custkey')} AS url FROM customer",
    "slug": f"SELECT c_custkey, replace({name('c_custkey')}, '/', '__') AS slug FROM customer",
    "key_shape": "SELECT c_custkey, c_custkey % 5 >= 3 AS well_formed FROM customer",
    "parse_date": "SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 4 THEN CAST(o_orderdate AS DATE) END AS day FROM orders",
    "parse_timestamp_utc": """
      SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 2 THEN CAST(epoch(date_trunc('second', o_orderdate)) AS BIGINT) - CASE WHEN o_orderkey % 4 = 1 THEN 28800 ELSE 0 END END AS epoch FROM orders""",
    "age_days": f"SELECT full_name, CAST(date_diff('day', created_day, {C}) AS INTEGER) AS age_days, CASE WHEN date_diff('day', created_day, {C}) <= 90 THEN 'NEW_HOT' ELSE 'REVIVED_HOT' END AS hot_type FROM enriched",
    "hot_type": f"SELECT full_name, CASE WHEN date_diff('day', created_day, {C}) <= {Q.NEW_DAYS} THEN 'NEW_HOT' ELSE 'REVIVED_HOT' END AS hot_type FROM enriched",
    "sha256": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "byte_length": "SELECT doc_id, CAST(strlen(text) AS INTEGER) AS bytes FROM documents",
    "clamp": "SELECT c_custkey, greatest(0.0, least(100.0, c_acctbal)) AS clamped FROM customer",
    "list_bullets": f"SELECT doc_id, sha256('- ' || replace(text, {N}, {N} || '- ')) AS bullets_sha256 FROM documents",
    "label": f"SELECT full_name, coalesce(nullif(language, ''), '{P.LABEL_NO_LANGUAGE}') AS language, coalesce(nullif(category, ''), '{P.LABEL_UNCATEGORIZED}') AS category FROM enriched",
    "frontmatter": """
      SELECT doc_id, full_name AS meta_full_name, source_url AS meta_source_url, CASE WHEN k % 47 = 9 THEN 'zz' ELSE source_sha256 END AS meta_source_sha256,
        CASE WHEN k % 41 = 7 THEN 'en' ELSE 'zh-CN' END AS meta_language, CASE WHEN k % 43 <> 8 THEN mode END AS meta_mode,
        k % 43 <> 8 AS complete, sha256(body) AS body_sha256 FROM local_docs""",
    "script_char_count": f"SELECT doc_id, CAST({script_chars('md')} AS INTEGER) AS script_chars FROM md_docs",
    "foreign_passage": f"SELECT doc_id, {foreign_passage('md')} AS foreign_passage FROM md_docs",
    "placeholder_rule": "SELECT doc_id, " + " OR ".join(f"contains(md, {quote(t)})" for t in P.PLACEHOLDERS) + " AS placeholder FROM md_docs",
    "fence_balance": f"SELECT doc_id, {odd_fences('md')} AS odd_fences FROM md_docs",
    "length_ratio": f"SELECT doc_id, CAST(source_bytes AS INTEGER) AS source_bytes, CAST(translation_bytes AS INTEGER) AS translation_bytes, {violations(*length_rules('mode', 'body'))} AS violations FROM local_docs",
    "markdown_structure": f"""
      SELECT doc_id, array_to_string({blocks('md')}, '|') AS blocks, array_to_string({headings('md')}, ',') AS headings, {unclosed('md')} AS unclosed FROM md_docs""",
    "nested_structure": f"""
      SELECT doc_id, CASE WHEN doc_id % 6 = 5 THEN '' ELSE array_to_string({blocks('md')}, '|') END AS blocks,
        CASE WHEN doc_id % 6 = 5 THEN '' ELSE array_to_string({headings('md')}, ',') END AS headings, doc_id % 6 <> 5 AND {unclosed('md')} AS unclosed FROM md_docs""",
    "nested_diff": f"""
      SELECT doc_id, {violations((unclosed('md'), 'unclosed_fence'), (f"doc_id % 6 = 5 AND len({blocks('md')}) > 0", 'code_blocks'), (f"doc_id % 6 = 5 AND len({headings('md')}) > 0", 'headings'))} AS violations FROM md_docs""",
    "structure_diff": f"SELECT doc_id, {violations(*structure_rules('mode', 'body', 'md'))} AS violations FROM local_docs",
    "markdown_section": f"""
      SELECT doc_id, sha256({section('md', 'Usage')}) AS usage_sha256, {sub(f"split_part({section('md', 'Summary')}, {N} || {N}, 1)", STRIP)} AS summary FROM md_docs""",
    "media_tags": f"SELECT doc_id, coalesce(array_to_string({media('md')}, ','), '') AS media_tags FROM md_docs",
    "page_outline": """
      SELECT page_id, CAST(unnest([1, 2]) AS INTEGER) AS position, unnest(['s' || page_id, 'end']) AS heading_id, unnest([trim('About ' || slug), 'End']) AS heading
      FROM (SELECT page_id, regexp_extract(html, '<a href="/([^"]*)"', 1) AS slug FROM pages)""",
    "parse_pages": f"""
      SELECT page_id, rank, 'org' || page_id || '/' || item AS full_name, '{P.SITE}/org' || page_id || '/' || item AS url,
        CASE WHEN shown = '' THEN 'About & more' ELSE 'About ' || shown || ' & more' END AS description,
        CASE WHEN page_id % 2 = 0 THEN 'Lang' END AS primary_language, page_id * 1000 + 234 AS total_stars, CAST(1200 AS BIGINT) AS total_forks,
        CASE WHEN page_id % 3 = 0 THEN page_id END AS period_stars, ltrim(item, '@') AS built_by FROM board_items""",
    "board_rank": "SELECT page_id, rank, 'org' || page_id || '/' || item AS full_name FROM board_items",
    "page_status": """
      SELECT page_id, CASE WHEN error IS NULL THEN 'success' ELSE 'failed' END AS status, error,
        CAST(CASE WHEN error IS NULL AND page_id % 10 <> 8 THEN len(items) ELSE 0 END AS INTEGER) AS entry_count FROM board_outcomes""",
    "broken_links": "SELECT DISTINCT page, href, target FROM site_links WHERE target NOT IN (SELECT target FROM site_targets)",
    "link_audit": """
      SELECT page, count(*) AS links, count(*) FILTER (target NOT IN (SELECT target FROM site_targets)) AS broken FROM site_links GROUP BY page""",
    "absolutize_links": f"""
      SELECT full_name, 'inline' AS syntax, './img/s.png' AS target, true AS image, raw || dir || 'img/s.png' AS absolute FROM link_docs WHERE doc_id % 3 = 0
      UNION ALL SELECT full_name, 'inline', '../docs/' || lang || '.md#top', false, blob || {DOTTED} FROM link_docs WHERE doc_id % 3 = 0
      UNION ALL SELECT full_name, 'html', 'clip ' || doc_id || '.mp4', true, raw || dir || 'clip%20' || doc_id || '.mp4' FROM link_docs WHERE doc_id % 3 = 0
      UNION ALL SELECT full_name, 'reference', 'docs/ref.md', false, blob || dir || 'docs/ref.md' FROM link_docs WHERE doc_id % 3 = 0""",
    "absolutize_text": f"""
      SELECT full_name, sha256(CASE WHEN doc_id % 3 <> 0 THEN md ELSE
        replace(replace(replace(replace(md, '(./img/s.png)', '(' || raw || dir || 'img/s.png)'), '(../docs/' || lang || '.md#top)', '(' || blob || {DOTTED} || ')'),
          'src="clip ' || doc_id || '.mp4"', 'src="' || raw || dir || 'clip%20' || doc_id || '.mp4"'), '[ref]: docs/ref.md', '[ref]: ' || blob || dir || 'docs/ref.md') END) AS text_sha256
      FROM link_docs""",
    "localized_validation": localized_statement(),
    "localized_collection": collection_statement(),
    "report_rules": report_statement(),
    "rendered_checks": rendered_statement(),
    "stream_boards": f"""
      SELECT capture_date, scope, period, item, metric, hits, rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY scope, period ORDER BY metric DESC, item) AS INTEGER) AS rank FROM (
          SELECT {SNAPSHOT_DAY} AS capture_date, s.scope, w.period, user_id AS item, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS metric, count(*) AS hits
          FROM events JOIN (VALUES {", ".join(f"('{p}', {d})" for p, d in P.PERIOD_DAYS.items())}) w(period, days)
            ON CAST(ts AS DATE) BETWEEN {SNAPSHOT_DAY} - w.days + 1 AND {SNAPSHOT_DAY}, LATERAL (SELECT unnest(['global', event_type]) AS scope) s
          WHERE {CLOSED_DAY} GROUP BY ALL)) WHERE rank <= {TOP}""",
    "stream_live_boards": f"""
      SELECT day, scope, item, metric, hits, rank, day + 1 <= (SELECT CAST(max(ts) AS DATE) FROM events) AS closed FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY day, scope ORDER BY metric DESC, item) AS INTEGER) AS rank FROM (
          SELECT CAST(ts AS DATE) AS day, s.scope, user_id AS item, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS metric, count(*) AS hits
          FROM events, LATERAL (SELECT unnest(['global', event_type]) AS scope) s GROUP BY ALL)) WHERE rank <= {TOP}""",
    "stream_dedup_evidence": f"""
      SELECT CAST(ts AS DATE) AS bucket_day, {name('user_id')} AS full_name, event_type AS kind, sha256(props) AS sha256,
        epoch_us(min(ts)) AS first_seen, count(*) AS copies FROM events WHERE {CLOSED_DAY} GROUP BY ALL""",
    "read_batch": "SELECT capture_date, scope, period, rank, full_name, period_stars, status FROM board",
    "write_snapshots": "SELECT capture_date, full_name, status, final_score FROM evals",
    "schema_conformance": f"""
      SELECT CAST(capture_date AS VARCHAR) AS doc, 'batch' AS object, CAST(0 AS BIGINT) AS position,
        CASE WHEN day(capture_date) = 30 THEN 'description' ELSE '' END AS violations FROM (SELECT DISTINCT capture_date FROM board)
      UNION ALL SELECT CAST(capture_date AS VARCHAR), 'page', CAST(page AS BIGINT), CASE WHEN scope = 'view' THEN 'scope' ELSE '' END FROM page_numbers
      UNION ALL SELECT CAST(capture_date AS VARCHAR), 'entry', CAST(page AS BIGINT) * 4294967296 + rank - 1, '' FROM board JOIN page_numbers USING (capture_date, page_no)
      UNION ALL SELECT CAST(capture_date AS VARCHAR), 'repository', CAST(row_number() OVER (PARTITION BY capture_date ORDER BY full_name) - 1 AS BIGINT),
        {violations(("k % 10 = 3", "missing_field"), ("k % 47 = 9", "card_extra_field"), ("k % 43 = 8", "card_features_items"))}
      FROM (SELECT DISTINCT capture_date, full_name FROM board) JOIN enriched USING (full_name)""",
}

ORACLE = {key: sql(statement) for key, statement in STATEMENTS.items()}
