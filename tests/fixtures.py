"""Small inputs with the shapes of a real batch."""

from __future__ import annotations

import hashlib

from pyspark.sql import Row, SparkSession

from rankloom import params as P

ENTRY_SCHEMA = (
    "capture_date DATE, page_no INT, scope STRING, period STRING, source_url STRING, captured_at STRING,"
    " raw_sha256 STRING, status STRING, rank INT, full_name STRING, url STRING, description STRING,"
    " primary_language STRING, total_stars BIGINT, total_forks BIGINT, period_stars BIGINT, built_by ARRAY<STRING>"
)
#: Two names on every page, and their figures for each period.
FRESH, KNOWN = "harbor/tidewatch", "lighthouse/lamplog"
GAINED = {"daily": (132, 17), "weekly": (618, 71), "monthly": (1430, 204)}


def entry(day, scope, period, rank, name, stars, page_no=0, status="success", **over):
    owner = name.partition("/")[0]
    page = f"{P.SITE}/trending/{scope}?since={period}"
    row = dict(capture_date=day, page_no=page_no, scope=scope, period=period, source_url=page, captured_at=f"{day}T06:40:00+00:00")
    row |= dict(raw_sha256=hashlib.sha256(page.encode()).hexdigest(), status=status, rank=rank, full_name=name, url=f"{P.SITE}/{name}")
    row |= dict(description=f"What {name} does", primary_language="Rust", total_stars=2750, total_forks=310, period_stars=stars)
    return row | {"built_by": [f"{owner}-keeper"]} | over


def entries(spark: SparkSession, rows) -> object:
    return spark.createDataFrame([Row(**r) for r in rows], ENTRY_SCHEMA)


def full_matrix(day):
    pages = [(scope, period) for period in P.PERIODS for scope in P.SCOPES]
    return [
        entry(day, scope, period, place + 1, name, GAINED[period][place], number, total_stars=2750 * (1 + place))
        for number, (scope, period) in enumerate(pages)
        for place, name in enumerate((FRESH, KNOWN))
    ]


REPOSITORY_SCHEMA = (
    "full_name STRING, url STRING, description STRING, category STRING, created_at STRING, pushed_at STRING,"
    " is_fork BOOLEAN, is_mirror BOOLEAN, archived BOOLEAN, language STRING, hard_filter MAP<STRING, BOOLEAN>,"
    " license STRUCT<name: STRING, scope_zh: STRING, evidence_urls: ARRAY<STRING>>,"
    " quality STRUCT<scores: MAP<STRING, INT>, total: INT, rationale: STRING, evidence_urls: ARRAY<STRING>>,"
    " value STRUCT<scores: MAP<STRING, INT>, total: INT, level: STRING, rationale: STRING, evidence_urls: ARRAY<STRING>>,"
    " card STRUCT<one_line: STRING, what: STRING, audience: ARRAY<STRING>, usage: STRING, features: ARRAY<STRING>,"
    " why: STRING, strengths: ARRAY<STRING>, limitations: ARRAY<STRING>, value: STRING>, evidence_urls: ARRAY<STRING>"
)


def points(limits, parts, link, **more):
    """Scores of a block, one part of each limit, with their sum."""
    scores = {key: limit * part // 20 for (key, limit), part in zip(limits.items(), parts)}
    return {"scores": scores, "total": sum(scores.values()), "rationale": "Read from the sources.", "evidence_urls": [link], **more}


def repository(name=FRESH, created="2026-07-19T08:15:00Z", **over):
    home = f"{P.SITE}/{name}"
    row = {"full_name": name, "url": home, "description": "Tide tables for small harbors", "category": "Navigation", "language": "Rust"}
    row |= {"created_at": created, "pushed_at": "2026-08-26T21:40:00Z", **dict.fromkeys(P.STATE_FLAGS, False)}
    row |= {"hard_filter": dict.fromkeys(P.GATES, True)}
    row |= {"license": {"name": "ISC", "scope_zh": "仓库内全部潮汐代码。", "evidence_urls": [f"{home}/blob/main/COPYING"]}}
    row |= {"quality": points(P.QUALITY_LIMITS, (18, 15, 16, 15, 14, 16, 16), home)}
    row |= {"value": points(P.VALUE_LIMITS, (17, 16, 16, 15, 16, 16, 16, 16), home, level="P3")}
    return row | {"card": card(name), "evidence_urls": [home, f"{home}/blob/main/docs/tides.md"]} | over


def card(name, **over):
    text = {
        "one_line": f"{name} 计算各港口的潮位。", "what": f"{name} 读取测站记录，算出每小时的水位。", "audience": ["引航员"],
        "usage": f"给 {name} 一个港口名和日期，得到当天的高低潮。", "features": [f"{name} 合并多站观测", f"{name} 绘制水位曲线"],
        "why": "沿海小港缺少可靠的潮汐表。", "strengths": [f"{name} 离线可用", f"{name} 占用内存很少"],
        "limitations": ["风暴增水不在模型里"], "value": "出海前核对水位省时可靠。",
    }
    return text | over


def repositories(spark, rows):
    return spark.createDataFrame(rows, REPOSITORY_SCHEMA)
