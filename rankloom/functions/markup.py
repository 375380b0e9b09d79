"""One grammar for HTML tags, as regular expressions, and decoding of character references.

A tag may be written in either case, and its attributes with double quotes, with single quotes or bare.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

COMMENT = r"(?s)<!--.*?-->"
#: The inside of a tag: quoted values may hold any sign.
INSIDE = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""
_UP_TO = r"""(?:[^>"']|"[^"]*"|'[^']*')*?"""
VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""


def has_class(name: str) -> str:
    """Lookahead: the class list of the tag holds the name."""
    spelled = "|".join(rf"{q}(?:[^{q}]*\s)?{name}(?:\s[^{q}]*)?{q}" for q in ('"', "'"))
    return rf"(?={_UP_TO}[\s\"'](?i:class)\s*=\s*(?:{spelled}|{name}(?=[\s>])))"


def has_value(attribute: str, value: str) -> str:
    """Lookahead: the attribute has just this value."""
    return rf"(?={_UP_TO}[\s\"'](?i:{attribute})\s*=\s*(?:\"{value}\"|'{value}'|{value}(?=[\s>])))"


def opening(tag: str, ahead: str = "") -> str:
    return rf"<(?i:{tag})(?=[\s>/]){ahead}{INSIDE}>"


def element(tag: str, ahead: str = "") -> str:
    """An element without elements of its kind inside; group 1 is the content."""
    return rf"(?s){opening(tag, ahead)}(.*?)</(?i:{tag})\s*>"


def attribute_in(tag: str, attribute: str, ahead: str = "") -> str:
    """Group 1 is the value as written; see ``value_of``."""
    return rf"<(?i:{tag})(?=[\s>/]){ahead}{_UP_TO}[\s\"'](?i:{attribute})\s*=\s*{VALUE}{INSIDE}>"


def value_of(written: Column) -> Column:
    """An attribute's value without its quotes, decoded."""
    return unescape(F.regexp_replace(written, r"""(?s)^(["'])(.*)\1$""", "$2"))


_NAMED = json.dumps({**name2codepoint, "apos": 39})


def computed_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _character(reference: Column) -> Column:
    """The character that a reference (without ``&`` and ``;``) stands for; null when there is none."""
    code = F.when(F.lower(F.substring(reference, 1, 2)) == "#x", F.conv(F.substring(reference, 3, 6), 16, 10)).when(
        F.startswith(reference, F.lit("#")), F.substring(reference, 2, 7)
    )
    names = F.from_json(F.lit(_NAMED), "map<string,int>")  # one constant, however often it is used
    point = F.coalesce(code.cast("int"), F.when(reference.rlike("^[A-Za-z]"), F.try_element_at(names, reference)))

    def encoded(p: Column) -> Column:
        valid = (p > 0) & (p < 0x110000) & ~p.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(p), 8, "0")), "UTF-32"))

    return computed_once(point, encoded)


def unescape(text: Column) -> Column:
    """Character references decoded once: numeric ones and those of HTML 4. Unknown ones stay.

    ``text`` is used once, so that a long expression is not repeated."""

    def referred(piece: Column, reference: Column) -> Column:
        rest = F.substr(piece, F.length(reference) + 2)
        kept = F.concat(F.lit("&"), piece)
        return F.when(reference == "", kept).otherwise(F.coalesce(F.concat(_character(reference), rest), kept))

    def decoded(piece: Column, place: Column) -> Column:
        reference = F.regexp_extract(piece, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        return F.when(place == 0, piece).otherwise(computed_once(reference, lambda r: referred(piece, r)))

    # most texts have none
    whole = lambda t: F.when(F.contains(t, F.lit("&")), F.array_join(F.transform(F.split(t, "&"), decoded), "")).otherwise(t)
    return computed_once(text, whole)
