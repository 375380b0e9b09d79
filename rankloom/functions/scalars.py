"""Column functions over numbers, keys, dates and scores. All stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankloom import params as P

ISO_TIME = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.]\d{1,6})?)?(?:Z|[+-]\d{2}:\d{2})?)?$"
COMPACT_NUMBER = r"(\d[\d,]*(?:\.\d+)?)\s*([kKmM])?\b"


def violations(*rules: tuple[Column, str]) -> Column:
    """Names of the rules whose condition holds; a null condition does not fire."""
    return F.array_except(F.array(*[F.when(bad, F.lit(name)) for bad, name in rules]), F.array(F.lit(None).cast("string")))


def parse_compact_number(text: Column) -> Column:
    """First number in ``text`` with an optional k/M suffix, truncated; 0 when there is none."""
    value = F.regexp_replace(F.regexp_extract(text, COMPACT_NUMBER, 1), ",", "")
    suffix = F.lower(F.regexp_extract(text, COMPACT_NUMBER, 2))
    scale = F.when(suffix == "k", 1000).when(suffix == "m", 1000000).otherwise(1)
    return F.when(value == "", F.lit(0).cast("bigint")).otherwise((value.cast("double") * scale).cast("bigint"))


def canonical_url(full_name: Column, site: str = P.SITE) -> Column:
    return F.concat(F.lit(site + "/"), full_name)


def slug(full_name: Column) -> Column:
    return F.replace(full_name, F.lit("/"), F.lit("__"))


def key_shape(full_name: Column) -> Column:
    return full_name.rlike(r"^[^/\s]+/[^/\s]+$")


def parse_date(text: Column) -> Column:
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def parse_timestamp_utc(text: Column) -> Column:
    """ISO date or timestamp with ``Z``, an offset or none; none means UTC, whatever the session's zone.
    Other spellings are null."""
    whole = F.when(text.rlike(ISO_TIME), text)
    seconds = F.regexp_replace(whole, r"^(\S{10}[T ]\d{2}:\d{2})(Z|[+-]\d{2}:\d{2})?$", "$1:00$2")
    timed = F.when(F.length(whole) == 10, F.concat(whole, F.lit("T00:00:00"))).otherwise(seconds)
    zoned = F.when(timed.rlike(r"(?:Z|[+-]\d{2}:\d{2})$"), timed).otherwise(F.concat(timed, F.lit("Z")))
    return F.try_to_timestamp(zoned)


def age_days(capture: Column, created_at: Column) -> Column:
    """Whole days from the UTC day of creation to the capture."""
    day = F.floor(F.unix_seconds(parse_timestamp_utc(created_at)) / 86400).cast("int")
    return F.date_diff(capture, F.date_add(F.lit("1970-01-01").cast("date"), day))


def hot_type(age: Column, new_days: int = P.NEW_HOT_DAYS) -> Column:
    return F.when(age <= new_days, "NEW_HOT").otherwise("REVIVED_HOT")


def clamp(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def round2(value: Column) -> Column:
    """Two decimals, taken through DECIMAL so that ties do not depend on binary noise."""
    return F.round(value.cast("decimal(20,8)"), 2).cast("double")


def momentum(previous: Column, current: Column) -> Column:
    """Clamped rank gain; neutral when one side is missing (greatest and least skip nulls)."""
    moved = F.lit(P.NEUTRAL) + (previous - current) * P.MOMENTUM_SLOPE
    return F.when(moved.isNull(), F.lit(P.NEUTRAL)).otherwise(clamp(moved))


def weighted(parts: dict[str, Column], weights: dict[str, float]) -> Column:
    """Weighted sum of already rounded parts, exact in DECIMAL(20,8)."""
    total = None
    for name, weight in weights.items():
        term = parts[name].cast("decimal(9,2)") * F.lit(f"{weight:.2f}").cast("decimal(3,2)")
        total = term if total is None else total + term
    return total.cast("decimal(20,8)")


def grade(score: Column) -> Column:
    chain = None
    for name, floor in P.GRADES:
        chain = F.when(score >= floor, name) if chain is None else chain.when(score >= floor, name)
    return chain


def map_total(scores: Column) -> Column:
    return F.aggregate(F.map_values(scores), F.lit(0).cast("bigint"), lambda acc, v: acc + v)


def components_in_range(scores: Column, limits: dict[str, int]) -> Column:
    """Exactly the expected keys, each between 0 and its limit."""
    bounds = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))])
    keys = F.array(*[F.lit(k) for k in sorted(limits)])
    inside = F.forall(F.map_entries(scores), lambda e: (e["value"] >= 0) & (e["value"] <= bounds[e["key"]]))
    return (F.array_sort(F.map_keys(scores)) == keys) & F.coalesce(inside, F.lit(False))


def same_keys(mapping: Column, keys: tuple[str, ...]) -> Column:
    return F.array_sort(F.map_keys(mapping)) == F.array(*[F.lit(k) for k in sorted(keys)])


def label(value: Column, default: str) -> Column:
    """Missing or empty text becomes the default label."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def bullets(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")


def distinct_sorted(*arrays: Column) -> Column:
    return F.array_sort(F.array_distinct(F.concat(*arrays)))
