"""Document structure in one pass per row: no explode, no shuffle, no Python. For texts without nested blocks.

Fences and headings are found with linear patterns, so a long document costs time in
proportion to its length and never leaves its row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankloom.functions.text import one_space, unix_lines

# indent or quote marks, fence of one character, info, content, closing fence at least as long;
# the info of a backtick fence has no backtick
FENCE = (
    r"(?ms)^([ \t>]*)(([`~])\3{2,}+)((?<=`)[^\n`]*|(?<=~)[^\n]*)\n(.*?)"
    r"^[ \t>]*\2\3*+[ \t]*$"
)
OPEN_FENCE = r"(?m)^[ \t>]*(?:`{3,}[^`\n]*|~{3,}[^\n]*)$"
ATX = r"^[ >]{0,3}#{1,6}(?=[ \t]|$)"
SETEXT = r"^(?=[^\s#>|*+=-])[^\n]++\n {0,3}(?:=+|-+)[ \t]*$"
HEADING = f"(?m)(?:{ATX}|{SETEXT})"


def _has_fence(text: Column) -> Column:
    return F.contains(text, F.lit("```")) | F.contains(text, F.lit("~~~"))


def fence_blocks(text: Column) -> Column:
    """``info`` + newline + content of each closed fence, in order, without container indent."""
    found = F.regexp_extract_all(unix_lines(text), F.lit(FENCE), F.lit(0))
    pieces = F.transform(
        found,
        lambda m: F.struct(
            F.regexp_extract(m, FENCE, 1).alias("indent"),
            F.regexp_extract(m, FENCE, 4).alias("info"),
            F.regexp_extract(m, FENCE, 5).alias("body"),
        ),
    )
    return F.transform(pieces, lambda r: F.concat(F.trim(r["info"]), F.lit("\n"), _dedent(r["body"], r["indent"])))


def _dedent(body: Column, indent: Column) -> Column:
    inner = F.replace(F.concat(F.lit("\n"), body), F.concat(F.lit("\n"), indent), F.lit("\n"))
    return F.when(indent == "", body).otherwise(F.substr(inner, F.lit(2)))


def without_fences(text: Column) -> Column:
    unix = unix_lines(text)
    return F.when(_has_fence(text), F.regexp_replace(unix, FENCE, "")).otherwise(unix)


# The functions below take text that ``without_fences`` has gone over: compute it once as a
# column where several of them are needed.


def open_fence_in(bare: Column) -> Column:
    """A fence is left that no closing fence belongs to."""
    return _has_fence(bare) & bare.rlike(OPEN_FENCE)


def headings_in(bare: Column) -> Column:
    """Levels of the headings, in order."""
    return F.transform(
        F.regexp_extract_all(bare, F.lit(HEADING), F.lit(0)),
        lambda h: F.when(h.rlike(r"^[ >]*#"), F.length(F.regexp_extract(h, r"(#+)", 1)))
        .when(h.rlike(r"=[ \t]*$"), F.lit(1))
        .otherwise(F.lit(2)),
    )


def prose_in(bare: Column) -> Column:
    """Text without inline code, link targets, tags and line markers."""
    for pattern, to in (
        (r"`[^`\n]*`", " "),
        (r"(!?)\[([^\]]*)\]\([^)]*\)", "$2"),
        (r"<[^>\n]*>", " "),
        (r"(?m)^[ \t]*(?:#{1,6}|>|[-*+]|\d+[.)])[ \t]+", ""),
    ):
        bare = F.regexp_replace(bare, pattern, to)
    return F.trim(one_space(bare))
