"""Link targets: splitting, dot-segment resolution and rewriting in place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankloom import params as P

SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
ABSOLUTE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:|#|//)"


def is_absolute(target: Column) -> Column:
    """Has a scheme, is a fragment, or starts at a host."""
    return target.rlike(ABSOLUTE)


def path_of(target: Column) -> Column:
    return F.regexp_extract(target, r"^([^?#]*)", 1)


def tail_of(target: Column) -> Column:
    """Query and fragment with their marks; '' when there is neither."""
    return F.regexp_extract(target, r"^[^?#]*(.*)$", 1)


def directory_of(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*/)[^/]*$", 1)


def resolve_dots(path: Column) -> Column:
    """Remove ``.`` and ``..`` segments; leading ``..`` that cannot be removed stay."""
    parts = F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))

    def step(acc: Column, part: Column) -> Column:
        climbs = (part == "..") & (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1)) != "..")
        return F.when(climbs, F.slice(acc, 1, F.size(acc) - 1)).otherwise(F.concat(acc, F.array(part)))

    return F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")


def unquote(text: Column) -> Column:
    plain = F.replace(text, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(plain), text)


def quote_path(path: Column) -> Column:
    """Percent-encode all but unreserved characters and ``/``."""
    coded = F.url_encode(path)
    for code, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        coded = F.replace(coded, F.lit(code), F.lit(plain))
    return coded


def repository_path(target: Column, doc_path: Column) -> Column:
    """The file that a target in a document names, from the repository's root. What would climb above the
    root starts there, without leading dots; no name at all is the folder itself. A target from
    the root keeps its slash."""
    written = path_of(target)
    from_root = F.startswith(written, F.lit("/"))
    plain = resolve_dots(F.concat(F.when(from_root, F.lit("")).otherwise(directory_of(doc_path)), written))
    climbing = plain.rlike(r"^\.\./")
    named = F.when(plain == "", F.lit(".")).when(climbing, F.ltrim(plain, F.lit("./"))).otherwise(plain)
    return F.concat(F.when(from_root, F.lit("/")).otherwise(F.lit("")), named)


def repository_site(image: Column, full_name: Column, branch: Column) -> Column:
    """Where a repository's files are shown: images as raw files, all else in the file view."""
    ref = F.replace(quote_path(branch), F.lit("/"), F.lit("%2F"))
    host = F.when(image, F.concat(F.lit(f"{P.RAW_SITE}/"), full_name)).otherwise(F.concat(F.lit(f"{P.SITE}/"), full_name, F.lit("/blob")))
    return F.concat_ws("/", host, ref, F.lit(""))


def absolute_target(target: Column, image: Column, full_name: Column, branch: Column, doc_path: Column) -> Column:
    """The address of a target in a document; absolute targets are kept."""
    place = F.concat(repository_site(image, full_name, branch), quote_path(repository_path(target, doc_path)), tail_of(target))
    return F.when(is_absolute(target), target).otherwise(place)


def rewrite_matches(text: Column, pattern: str, fn: Callable[[Column], Column]) -> Column:
    """Replace every match of ``pattern`` by ``fn(match)``, all else unchanged."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rewritten = F.concat(F.transform(matches, fn), F.array(F.lit("")))
    pairs = F.zip_with(between, rewritten, lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))
    return F.array_join(pairs, "")
