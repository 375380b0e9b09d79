"""Column functions over prose: scripts, foreign passages, fences, media, sections."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankloom import params as P

COMMENT, FENCED, DATA_URI, WEB_URL, FRONTMATTER = P.COMMENT, P.FENCED, P.DATA_URI, P.WEB_URL, P.FRONTMATTER
INLINE_CODE, QUOTED_LINE = P.INLINE_CODE, P.QUOTED_LINE
FENCED_ANY = FENCED + r"|~~~.*?~~~"
INLINE_CODE_LINE = r"`[^`\n]*`"
IMAGE_LINK = r"!\[[^\]]*\]\([^)]+\)"


# A literal that a pattern cannot match without. A text without it is passed on as it is: the
# byte search is much cheaper than a regex pass, and most texts have few of the markers.
MARKERS = {
    COMMENT: "<!--", FENCED: "```", INLINE_CODE: "`", DATA_URI: "data:", WEB_URL: "http", INLINE_CODE_LINE: "`",
}


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` uses it."""
    return F.transform(F.array(value), fn)[0]


def drop(text: Column, *patterns: str) -> Column:
    for pattern in patterns:
        text = let(text, _dropper(pattern))
    return text


def _dropper(pattern: str) -> Callable[[Column], Column]:
    marker = MARKERS.get(pattern)
    if not marker:
        return lambda t: F.regexp_replace(t, pattern, "")
    return lambda t: F.when(F.contains(t, F.lit(marker)), F.regexp_replace(t, pattern, "")).otherwise(t)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))


def unix_lines(text: Column) -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def one_space(text: Column) -> Column:
    """Each run of white space as one space. Single spaces, the most of them, are not matched."""
    return F.regexp_replace(text, r"\s(?:(?<! )\s*+|\s++)", " ")


def fold_whitespace(text: Column) -> Column:
    """Collapse whitespace, trim, fold case: the comparison form of list items."""
    return F.lower(F.trim(one_space(text)))


def each_char(chars: str) -> str:
    """A character class with its ASCII ranges written out: Java looks single characters up in one table, but asks range by range."""
    return re.sub("([A-Za-z0-9])-([A-Za-z0-9])", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), chars)


def has_foreign_run(text: Column, run: int) -> Column:
    """A letter followed by ``run`` characters of foreign prose.

    A match is looked for at the start of each stretch of such characters only: its first
    letter has the most characters after it. So every character is visited once.
    """
    stretch, others, letters = (each_char(x) for x in (P.FOREIGN_RUN, P.FOREIGN_RUN.replace("A-Za-z", ""), "A-Za-z"))
    return text.rlike(f"(?<![{stretch}])[{others}]*+[{letters}][{stretch}]{{{run}}}")


def native_explanation(text: Column, script: str = P.NATIVE_SCRIPT, run: int = P.CARD_FOREIGN_RUN_MIN) -> Column:
    """At least one character of the script, and no long foreign clause."""
    return text.rlike(f"[{script}]") & ~has_foreign_run(text, run)


def script_chars(text: Column, script: str = P.NATIVE_SCRIPT) -> Column:
    """Characters of the script outside comments, fences, data URIs and URLs."""
    prose = drop(text, COMMENT, FENCED, DATA_URI, WEB_URL)
    return F.length(F.regexp_replace(prose, f"[^{script}]+", ""))


def latin_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[A-Za-z]{3,}"))


def prose_for_language(text: Column) -> Column:
    prose = drop(text, COMMENT, FENCED, QUOTED_LINE, INLINE_CODE, DATA_URI, WEB_URL)
    return one_space(prose)


def has_foreign_passage(text: Column, run: int = P.DOCUMENT_FOREIGN_RUN_MIN) -> Column:
    return has_foreign_run(prose_for_language(text), run)


def contains_any(text: Column, phrases: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(text, F.lit(phrase))
    return found


def has_placeholder(text: Column, tokens: tuple[str, ...] = P.PLACEHOLDERS) -> Column:
    return contains_any(text, tokens)


def odd_fences(text: Column) -> Column:
    fences = (F.length(text) - F.length(F.replace(text, F.lit("```"), F.lit("")))) / 3
    return fences.cast("int") % 2 == 1


def live_markdown(text: Column) -> Column:
    """Text without fenced and inline code."""

    def unfenced(t: Column) -> Column:
        fenced = F.contains(t, F.lit("```")) | F.contains(t, F.lit("~~~"))
        return F.when(fenced, F.regexp_replace(t, FENCED_ANY, "")).otherwise(t)

    return drop(let(text, unfenced), INLINE_CODE_LINE)


def media_tags(text: Column) -> Column:
    """Sorted media tags that are live, i.e. outside code; image syntax counts as ``img``."""
    names = "|".join(P.MEDIA_TAGS)
    found = F.regexp_extract_all(live_markdown(text), F.lit(rf"(?i)<(?:{names})\b|{IMAGE_LINK}"), F.lit(0))
    tags = F.transform(found, lambda m: F.when(F.startswith(m, F.lit("<")), F.lower(F.substring(m, 2, 10))).otherwise("img"))
    return F.array_sort(F.array_distinct(tags))


def section(text: Column, heading: str) -> Column:
    """Text between ``## heading`` and the next second-level heading, trimmed; '' when absent."""
    quoted = "".join("\\" + c if c in r"\.+*?()[]{}|^$" else c for c in heading)
    return strip(F.regexp_extract(text, rf"(?ms)^## {quoted}\s*$\n(.*?)(?=^## |\z)", 1))


def first_paragraph(text: Column) -> Column:
    return strip(F.split(text, "\n\n", 2)[0])


def frontmatter_block(text: Column) -> Column:
    """The lines between the leading ``---`` marks; null when there is no such block."""
    unix = unix_lines(text)
    return F.when(unix.rlike(FRONTMATTER), F.regexp_extract(unix, FRONTMATTER, 1))


def frontmatter_entries(text: Column) -> Column:
    """``key: value`` lines as structs, split at the first colon."""
    lines = F.filter(F.split(frontmatter_block(text), "\n"), lambda line: F.contains(line, F.lit(":")))
    return F.transform(
        lines,
        lambda line: F.struct(
            strip(F.regexp_extract(line, r"^([^:]*):", 1)).alias("key"),
            strip(F.regexp_extract(line, r"^[^:]*:(.*)$", 1)).alias("value"),
        ),
    )


def frontmatter_value(entries: Column, key: str) -> Column:
    """The value of ``key``; when it is repeated the last one counts."""
    return F.try_element_at(F.filter(entries, lambda e: e["key"] == key), F.lit(-1))["value"]


def frontmatter_complete(entries: Column, keys: tuple[str, ...] = P.FRONTMATTER_KEYS) -> Column:
    found = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["key"])))
    return F.coalesce(found == F.array(*[F.lit(k) for k in sorted(keys)]), F.lit(False))


def frontmatter_body(text: Column) -> Column:
    return strip(F.regexp_replace(unix_lines(text), FRONTMATTER, ""))
