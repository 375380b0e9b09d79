"""Markdown blocks of texts in which containers (quotes, list items) and other blocks are nested.

A state machine over lines with a stack of open containers: a line first continues the containers that are
open, then the open leaf (a fence, raw HTML, a paragraph), then may open new ones. It keeps what structure
checks compare: fences, heading levels, running text. Linear patterns (``functions.markdown``) do for texts
without such nesting; ``NESTED`` tells which need the machine.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from rankloom import params as P

SHAPE = T.StructType(
    [
        T.StructField("blocks", T.ArrayType(T.StringType())),
        T.StructField("headings", T.ArrayType(T.IntegerType())),
        T.StructField("prose", T.StringType()),
        T.StructField("unclosed", T.BooleanType()),
    ]
)
#: Containers inside each other; marks beyond are running text, so that a line costs time in proportion to its length.
DEEPEST = 100
#: Texts whose structures are Python objects at a time; of the others only the Arrow data is held.
TOGETHER = 64

# Lines by which blocks may be nested: a mark behind a container's mark or an indent, an underline that a container, an
# indent or a definition makes doubtful, raw HTML that goes on behind its first line. Too many texts may match, none too few.
_MARK = r"(?:#{1,6}(?:[ \t]|$)|`{3}|~{3})"
_CONTAINER = r"(?:>|[-*+]|\d{1,9}[.)])"
_UNDERLINE = r"[ \t>]*+(?:=+|-+)[ \t]*$"
NESTED = "(?m)" + "|".join(
    [
        rf"^[ \t]*+{_CONTAINER}[ \t>*+.)0-9-]*?{_MARK}",
        rf"^(?: {{2,}}|[ ]*\t)[ \t]*+{_MARK}",
        rf"^[ \t]*+{_CONTAINER}[^\n]*+\n(?:(?![ \t]*\n|{_UNDERLINE})[^\n]*+\n)*+{_UNDERLINE}",
        rf"^(?:[ \t]+\S|[|=]| {{0,3}}\[[^\n\]]*\]:)[^\n]*+\n{_UNDERLINE}",
        r"^ {0,3}<[A-Za-z/][^\n]*+\n[ \t]*+\S",
        r"^ {0,3}<!--(?![^\n]*-->)",
        r"^ {0,3}<(?i:script|pre|style|textarea)\b(?![^\n]*</(?i:script|pre|style|textarea)>)",
        r"^ {0,3}<\?(?![^\n]*\?>)",
        r"^ {0,3}<!\[CDATA\[(?![^\n]*\]\]>)",
        r"^ {0,3}<![A-Za-z](?![^\n]*>)",
        r"\r(?!\n)",
    ]
)

ATX = re.compile(r"(#{1,6})(?=[ \t]|$)")
UNDERLINE = re.compile(r"(?:=+|-+)[ \t]*$")
RULE = re.compile(r"(?:(?:\*[ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})$")
FENCE = re.compile(r"(`{3,})([^`]*)$|(~{3,})(.*)$")
ITEM = re.compile(r"([-*+]|(\d{1,9})[.)])(?=[ \t]|$)")
DEFINITION = re.compile(r" {0,3}\[[^\]\[]+\]:[ \t]*\S+(?:[ \t]+(?:\"[^\"]*\"|'[^']*'|\([^)]*\)))?[ \t]*$")
#: Raw HTML that ends with a mark of its own, on its first line or later.
RAW = [
    (re.compile(r"<(?:script|pre|style|textarea)(?:\s|>|$)", re.I), re.compile(r"</(?:script|pre|style|textarea)>", re.I)),
    (re.compile(r"<!--"), re.compile(r"-->")),
    (re.compile(r"<\?"), re.compile(r"\?>")),
    (re.compile(r"<![A-Za-z]"), re.compile(r">")),
    (re.compile(r"<!\[CDATA\["), re.compile(r"\]\]>")),
]
BLOCK_TAG = re.compile(r"</?(?:" + "|".join(P.HTML_BLOCK_TAGS) + r")(?:\s|/?>|$)", re.I)
_ATTRIBUTE = r"\s+[A-Za-z_:][\w.:-]*(?:\s*=\s*(?:[^\s\"'=<>`]+|'[^']*'|\"[^\"]*\"))?"
LONE_TAG = re.compile(rf"(?:<[A-Za-z][A-Za-z0-9-]*(?:{_ATTRIBUTE})*\s*/?>|</[A-Za-z][A-Za-z0-9-]*\s*>)\s*$")
BLANK_ENDS = re.compile(r"[ \t]*$")
MARKS = frozenset(">#`~<=-_*+0123456789")


def indent(text: str, column: int) -> int:
    """Columns of white space in front; a tab reaches to the next multiple of four."""
    at = column
    for c in text:
        if c == " ":
            at += 1
        elif c == "\t":
            at += 4 - at % 4
        else:
            break
    return at - column


def unindent(text: str, column: int, most: int) -> tuple[str, int]:
    """Text without up to ``most`` columns of leading white space, and the column where it goes on."""
    at, end, k = column, column + most, 0
    while k < len(text) and at < end and text[k] in " \t":
        at += 1 if text[k] == " " else 4 - at % 4
        k += 1
    return (" " * (at - end) + text[k:], end) if at > end else (text[k:], at)


class Blocks:
    """Structure of one text, fed line by line."""

    def __init__(self) -> None:
        self.stack: list[int | None] = []  # of each open container: an item's width, None for a quote
        self.bare: list[bool] = []  # of each: an item without content so far
        self.leaf: tuple | None = None  # ("text", lines), ("fence", mark, indent, info, lines), ("raw", end)
        self.blocks: list[str] = []
        self.levels: list[int] = []
        self.prose: list[str] = []
        self.unclosed = False

    def end_leaf(self) -> None:
        leaf, self.leaf = self.leaf, None
        if leaf and leaf[0] == "fence":
            self.unclosed = True
        elif leaf and leaf[0] == "text":
            lines = leaf[1]
            while lines and DEFINITION.match(lines[0]):
                lines = lines[1:]
            self.prose.extend(line.strip() for line in lines)

    def end_containers(self, kept: int) -> None:
        """Close all but the first ``kept`` containers, and the leaf."""
        self.end_leaf()
        del self.stack[kept:], self.bare[kept:]

    def continued(self, text: str, column: int) -> tuple[str, int, int]:
        """What is left of a line behind the marks of open containers, its column, and how many go on."""
        for k, width in enumerate(self.stack):
            free = indent(text, column)
            blank = not text.strip(" \t")
            if width is None:
                if free > 3 or not text.lstrip(" \t").startswith(">"):
                    return text, column, k
                text, column = unindent(text, column, free)
                text, column = unindent(text[1:], column + 1, 1)
            elif blank:
                if self.bare[k]:
                    return text, column, k
            elif free >= width:
                text, column = unindent(text, column, width)
            else:
                return text, column, k
        return text, column, len(self.stack)

    def feed(self, line: str) -> None:
        text, column, kept = self.continued(line, 0)
        whole = kept == len(self.stack)
        if whole and self.leaf and self.leaf[0] != "text":
            return self.go_on(text, column)
        opened = False
        while text.strip(" \t"):
            free = indent(text, column)
            body = text.lstrip(" \t")
            running = self.leaf is not None and self.leaf[0] == "text" and not opened
            if free > 3:
                if running:
                    break
                if not opened:
                    self.end_containers(kept)
                return self.filled()  # indented code
            if body[0] not in MARKS:
                break
            if running and whole and UNDERLINE.match(body) and any(not DEFINITION.match(x) for x in self.leaf[1]):
                self.levels.append(1 if body[0] == "=" else 2)
                return self.end_leaf()
            item = None
            if body[0] == ">":
                width = None
            elif atx := ATX.match(body):
                self.begin(kept, opened)
                self.levels.append(len(atx[1]))
                return self.prose.append(body[atx.end() :].strip(" \t"))
            elif fence := FENCE.match(body):
                self.begin(kept, opened)
                self.leaf = ("fence", fence[1] or fence[3], free, (fence[2] if fence[1] else fence[4]).strip(" \t"), [])
                return None
            elif body[0] == "<" and (end := self.raw(body, running)):
                self.begin(kept, opened)
                self.leaf = None if end.search(body) and end is not BLANK_ENDS else ("raw", end)
                return None
            elif RULE.match(body):
                return self.begin(kept, opened)
            elif (item := ITEM.match(body)) and not (running and whole and (item.end() == len(body.rstrip(" \t")) or item[2] not in (None, "1"))):
                width = self.item_width(item, body, column + free, free)
            else:
                break
            if (len(self.stack) if opened else kept) >= DEEPEST:
                break
            if not opened:
                self.end_containers(kept)
            opened = True
            self.filled()
            text, column = unindent(text, column, free)
            if width is None:
                text, column = unindent(text[1:], column + 1, 1)
            else:
                text, column = unindent(text[item.end() :], column + item.end(), width - free - item.end())
            self.stack.append(width)
            self.bare.append(width is not None)
            kept, whole = len(self.stack), True
        if not text.strip(" \t"):
            if not opened:  # a blank line ends the text and the containers that it does not continue
                if not whole or (self.leaf and self.leaf[0] == "text"):
                    self.end_containers(kept)
        elif self.leaf and self.leaf[0] == "text" and not opened:
            self.leaf[1].append(text)  # behind an unmarked line, a text goes on in its container
        else:
            self.begin(kept, opened)
            self.leaf = ("text", [text])
        return None

    def begin(self, kept: int, opened: bool) -> None:
        """A leaf begins in the innermost container that goes on."""
        if not opened:
            self.end_containers(kept)
        self.filled()

    def filled(self) -> None:
        if self.bare:
            self.bare[-1] = False

    def go_on(self, text: str, column: int) -> None:
        """A line inside an open fence or raw HTML."""
        if self.leaf[0] == "raw":
            if self.leaf[1].search(text) if self.leaf[1] is not BLANK_ENDS else BLANK_ENDS.match(text):
                self.leaf = None
            return
        _, mark, inner, info, lines = self.leaf
        body = text.strip(" \t")
        if indent(text, column) <= 3 and len(body) >= len(mark) and body == mark[0] * len(body):
            self.blocks.append(info + "\n" + "".join(x + "\n" for x in lines))
            self.leaf = None
        else:
            lines.append(unindent(text, column, inner)[0])

    @staticmethod
    def raw(body: str, running: bool) -> re.Pattern | None:
        """The end of the raw HTML that ``body`` begins; blank lines end blocks without a mark of their own."""
        for start, end in RAW:
            if start.match(body):
                return end
        return BLANK_ENDS if BLOCK_TAG.match(body) or (not running and LONE_TAG.match(body)) else None

    @staticmethod
    def item_width(item: re.Match, body: str, column: int, free: int) -> int:
        """Columns from the item's line start to its content."""
        rest = body[item.end() :]
        gap = indent(rest, column + item.end())
        return free + item.end() + (gap if rest.strip(" \t") and gap <= 4 else 1)


def structure_of(text: str) -> dict:
    found = Blocks()
    for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        found.feed(line)
    found.end_containers(0)
    return {"blocks": found.blocks, "headings": found.levels, "prose": "\n".join(found.prose), "unclosed": found.unclosed}


@F.arrow_udf(SHAPE)
def _structures(texts: pa.Array) -> pa.Array:
    kind = to_arrow_type(SHAPE)
    done = [
        pa.array([None if t is None else structure_of(t) for t in texts.slice(at, TOGETHER).to_pylist()], kind) for at in range(0, len(texts), TOGETHER)
    ]
    return pa.concat_arrays(done) if done else pa.array([], kind)


def nested_structure(text: Column) -> Column:
    """Structure of a text whose blocks are nested; null for others, which never reach Python."""
    return _structures(F.when(text.rlike(NESTED), text))
