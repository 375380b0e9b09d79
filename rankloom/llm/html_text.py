"""Main text of HTML pages, with boilerplate found by runs that repeat over each host's pages.

Structure first. A page is cut into blocks at its block elements; scripts, styles and markup are not text. A
block inside an element that is a menu, header, footer, sidebar, notice, advert, form or comment by its tag,
role or class is dropped. A block inside an article (or the page's main part) is kept whole. A class or id only tells
if all its parts are such words or words of layout: "share-buttons" does, "share-price" does not. It says nothing
of a heading, paragraph, list item, quote or table inside an article, and an article inside an element that only its class tells
to be something else is kept if the page has no other.

What structure leaves open, text outside any article, is decided by repetition. All text outside articles is
a token stream. The streams of a host's pages, in blocks of bounded size, are put in a suffix array with the
lengths that neighbours have in common; stretches of it tell on how many pages a run is. Runs of different
blocks are brought together by a polynomial hash of their tokens, and their pages added.
A run of an open block is boilerplate, and is removed, when it is

- a substring of at least ``LONG`` tokens, anywhere;
- a row of whole blocks with at least ``MIN_RUN`` tokens together, also where a block only begins or ends with it;
- a shorter block, whole;

on a share of the host's pages (``SHARE``, for short blocks ``SHORT_SHARE``) and on ``min_pages`` pages, or all
pages of a smaller host. Pages with the same main text (open and kept blocks) count as one, so a page served at several addresses is not
taken for boilerplate. Substrings of just ``LONG`` tokens are enough for the first rule: a longer one is on enough pages
only if each of its windows is, and they cover it. Rows of blocks are keyed by the fewest blocks that
have the tokens, forward from each block and backward to it, which cover every longer row.

A host with most of the pages has many blocks, and a passage's counts are combined map-side; a page's own markup decides
whether this is needed, so pages without open blocks are never moved, and hosts without such a page are not sorted.

Null or empty html gives an empty text. Repeated rows give one row each, and count as one page. Null
page ids are ordinary values. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.session import stored

MIN_RUN = 5
MIN_PAGES = 3
#: Tokens of a run that is boilerplate wherever it stands, without regard to blocks.
LONG = 20
#: Share of the host's pages that a run must be on; the second for blocks of less than MIN_RUN tokens.
SHARE, SHORT_SHARE = 0.25, 0.5
#: Kinds of keys: LONG tokens, rows of whole blocks, a short block.
RUN, WHOLE, SHORT = 0, 1, 2
#: Ends a stretch of tokens; tokens of the pages that share a suffix array.
BORDER, BLOCK_TOKENS = -1, 1 << 18
_PRIME, _BASE = (1 << 61) - 1, 0x1C3A5F7296B4D81
_SALTS = 64

#: SUSPECT: dropped for a class alone; PERHAPS: an article in there, kept if there is no other.
DROP, OPEN, KEEP, SUSPECT, PERHAPS = 0, 1, 2, 3, 4

_RAW = {"script", "style", "template", "textarea", "title", "svg", "iframe", "noembed", "noframes", "xmp", "math", "object", "audio", "video", "canvas", "select"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_CHROME_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head", "noscript"}
_BLOCKS = _CHROME_TAGS | {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "html", "legend", "li", "main", "ol", "optgroup", "option", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar", "form"}
_CHROME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsbygoogle", "sponsor", "sponsored", "promo", "promotion",
    "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "widget", "pagination", "pager",
    "comment", "comments", "disqus", "reply", "replies", "respond", "share", "sharing", "social", "related", "recommended", "login", "toolbar",
}
_CHROME_NAMES = {"header", "footer", "banner", "masthead", "aside", "site-header", "page-header", "site-footer", "page-footer", "top-bar", "topbar", "search"}
#: Words of layout, which say nothing by themselves.
_LAYOUT_WORDS = {
    "area", "bar", "block", "bottom", "box", "btn", "button", "buttons", "center", "col", "column", "container", "content", "form", "group",
    "holder", "icon", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "mobile", "outer", "panel", "post",
    "posts", "primary", "right", "row", "secondary", "section", "site", "slot", "thread", "title", "top", "unit", "wrap", "wrapper",
}
#: Elements of running text, which their class can't drop from an article.
_PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "table", "tbody", "tr", "td", "th", "dl", "dt", "dd", "figure"}
#: In the class of an article itself only these tell that it is none.
_NO_ARTICLE = {"ad", "ads", "advert", "advertisement", "sponsored", "promo", "comment", "comments", "reply"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_LEAVES = {"p", "li", "dt", "dd", "option", "tr", "td", "th"}


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): entities.unescape(v.strip("\"'")).lower() for k, v in reversed(_ATTRIBUTE.findall(text))}


def _role(tag: str, attributes: str, inside: int) -> int:
    """What an element makes of its content, given what holds around it."""
    if inside == DROP:
        return DROP
    held = _attributes(attributes) if attributes.strip() else {}
    names = set(f"{held.get('class', '')} {held.get('id', '')}".split())
    if "hidden" in held or held.get("aria-hidden") == "true" or held.get("role") in _CHROME_ROLES:
        return DROP
    if tag in ("html", "body"):
        return inside
    if tag in ("article", "main") or held.get("role") in ("article", "main"):
        if any(_tells(n, _NO_ARTICLE) for n in names):
            return DROP
        return PERHAPS if inside in (SUSPECT, PERHAPS) else KEEP
    if tag == "header":
        return inside if inside in (KEEP, PERHAPS) else DROP
    if tag in _CHROME_TAGS:
        return DROP
    if inside in (KEEP, PERHAPS) and tag in _PROSE:
        return inside
    if any(_tells(n, _NO_ARTICLE) for n in names):
        return DROP
    if inside != SUSPECT and (names & _CHROME_NAMES or any(_tells(n, _CHROME_WORDS) for n in names)):
        return DROP if inside in (KEEP, PERHAPS) else SUSPECT
    return inside


@lru_cache(maxsize=1 << 14)
def _parts(name: str) -> frozenset[str]:
    return frozenset(p.rstrip("0123456789") for p in re.split(r"[-_]+", name)) - {""}


def _tells(name: str, words: set[str]) -> bool:
    """A class or id whose parts are all of these words or of layout."""
    parts = _parts(name)
    return bool(parts & words) and parts <= words | _CHROME_WORDS | _CHROME_NAMES | _LAYOUT_WORDS


def _settled(found: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """Roles once the whole page is known."""
    perhaps = DROP if any(role == KEEP for role, _ in found) else KEEP
    return [(perhaps if role == PERHAPS else DROP if role == SUSPECT else role, text) for role, text in found]


def blocks(html: str) -> list[tuple[int, str]]:
    """(role, text) of the blocks of a page, in page order; texts are decoded and never empty."""
    found: list[tuple[int, str]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int]] = []
    role, at, n = OPEN, 0, len(html)

    def close() -> None:
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                found.append((role, text))
            pieces.clear()

    while at < n:
        m = _TAG.search(html, at)
        if not m:
            pieces.append(html[at:])
            break
        if m.start() > at:
            pieces.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag == "br":
            pieces.append(" ")
        elif tag in _RAW and not m[1]:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = end.end() if end else n
            if tag not in ("svg", "math", "object"):
                pieces.append(" ")
        elif tag in _VOID:
            if tag == "hr":
                close()
        elif m[1]:
            if tag in _BLOCKS:
                close()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if tag not in _BLOCKS and stack[k][1] != role:
                        close()
                    del stack[k:]
                    role = stack[-1][1] if stack else OPEN
                    break
                if tag not in _BLOCKS and stack[k][0] in _BLOCKS:
                    break
        else:
            if tag in _BLOCKS:
                close()
                if tag in _LEAVES or tag in ("article", "section", "div", "ul", "ol", "table", "main"):
                    while stack and stack[-1][0] not in _BLOCKS:  # inline elements left open end with their block
                        stack.pop()
                    if stack and stack[-1][0] == "p" or stack and tag == stack[-1][0] and tag in _LEAVES:
                        stack.pop()
                    role = stack[-1][1] if stack else OPEN
            new = _role(tag, m[3], role)
            if tag not in _BLOCKS and new != role:
                close()
            stack.append((tag, new))
            role = new
    close()
    return _settled(found)


def host_of(url: str | None) -> str:
    return re.sub(r"^[a-z][a-z0-9+.-]*://|^//", "", (url or "").lower()).split("/")[0].split("?")[0].split("#")[0].rsplit("@", 1)[-1].split(":")[0]


@lru_cache(maxsize=1 << 16)
def _number(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") % _PRIME


def _page(found: list[tuple[int, str]], dropped: bool = False) -> int:
    """A hash of what the page says in open and kept blocks, or in all."""
    return _number.__wrapped__("\0".join(f"{role}{text}" for role, text in found if dropped or role != DROP))


def _occurrences(found: list[tuple[int, str]], partly: bool = False) -> Iterator[tuple[int, int, int]]:
    """(key, start, end) of the runs outside articles; no run reaches over an article. ``partly`` adds block starts and ends."""
    at = 0
    for kept, group in groupby(found, key=lambda b: b[0] == KEEP):
        if kept:
            continue
        cuts, sums = [0], [0]
        for _, text in group:
            for token in text.split():
                sums.append((sums[-1] * _BASE + _number(token)) % _PRIME)
            cuts.append(len(sums) - 1)
        n, last = cuts[-1], len(cuts) - 1

        def run(kind: int, i: int, j: int) -> tuple[int, int, int]:
            return (sums[j] - sums[i] * pow(_BASE, j - i, _PRIME)) % _PRIME * 4 + kind, at + i, at + j

        shift = pow(_BASE, LONG, _PRIME)
        for i in range(n - LONG + 1):
            yield (sums[i + LONG] - sums[i] * shift) % _PRIME * 4 + RUN, at + i, at + i + LONG
        for b in range(last):
            start, end = cuts[b], cuts[b + 1]
            if end - start < MIN_RUN:
                yield run(SHORT, start, end)
            to = next((e for e in range(b + 1, last + 1) if cuts[e] - start >= MIN_RUN), None)
            if to:
                yield run(WHOLE, start, cuts[to])
            since = next((s for s in range(b, -1, -1) if end - cuts[s] >= MIN_RUN), None)
            if since is not None and since < b:
                yield run(WHOLE, cuts[since], end)
            for size in range(MIN_RUN, min(LONG, end - start)) if partly else ():
                yield run(WHOLE, start, start + size)
                yield run(WHOLE, end - size, end)
        at += n


def _keys(found: list[tuple[int, str]], partly: bool = False) -> list[int]:
    return sorted({key for key, _, _ in _occurrences(found, partly)})


def unique_text(found: list[tuple[int, str]], repeated: set[int]) -> str:
    """Kept blocks, and of open ones what no repeated run covers, in page order."""
    covered = [False] * sum(len(text.split()) for role, text in found if role != KEEP)
    for key, start, end in _occurrences(found, True) if repeated else ():
        if key in repeated:
            covered[start:end] = [True] * (end - start)
    out, at = [], 0
    for role, text in found:
        if role == KEEP:
            out.append(text)
        else:
            own = text.split()
            if role == OPEN:
                out += [w for w, c in zip(own, covered[at : at + len(own)]) if not c]
            at += len(own)
    return " ".join(out)


def _stream(found: list[tuple[int, str]]) -> tuple[list[int], list[int]]:
    """Token numbers of the blocks outside articles, BORDER behind each stretch of them, and the blocks' ends."""
    tokens: list[int] = []
    ends: list[int] = []
    for kept, group in groupby(found, key=lambda b: b[0] == KEEP):
        if not kept:
            for _, text in group:
                tokens += map(_number, text.split())
                ends.append(len(tokens))
            tokens.append(BORDER)
    return tokens, ends


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the order of the suffixes that begin there, compared over LONG tokens and up to a border; the tokens that each
    suffix in this order has in common with the one before; and the tokens from each place to its border."""
    n = len(tokens)
    borders = np.flatnonzero(tokens == BORDER)
    left = borders[np.searchsorted(borders, np.arange(n))] - np.arange(n)
    rank = np.unique(tokens, return_inverse=True)[1].reshape(-1) + 1
    rank[left == 0] = 0
    ranks = {1: rank}
    for half, more in ((1, 1), (2, 2), (4, 4), (8, 8), (16, LONG - 16)):
        rest = np.zeros(n, np.int64)
        whole = np.flatnonzero(left >= half)
        rest[whole] = ranks[more][whole + half]
        ranks[half + more] = np.unique(ranks[half] * (n + 2) + rest, return_inverse=True)[1].reshape(-1)
    order = np.argsort(ranks[LONG], kind="stable")
    common = np.zeros(n, np.int64)
    for k in (16, 8, 4, 2, 1):
        a, b = order[1:] + common[1:], order[:-1] + common[1:]
        inside = np.flatnonzero(np.minimum(left[order[1:]], left[order[:-1]]) - common[1:] >= k)
        common[1 + inside[ranks[k][a[inside]] == ranks[k][b[inside]]]] += k
    return order, np.minimum(common, LONG), left


def _runs(tokens: np.ndarray, ends: np.ndarray, left: np.ndarray) -> dict[int, np.ndarray]:
    """By length up to LONG, the places of runs that count: LONG tokens, shorter rows of whole blocks, short blocks."""
    runs: dict[int, set[int]] = {size: set() for size in range(1, LONG)}
    previous = np.concatenate([[0], ends[:-1]])
    starts = np.where(tokens[previous] == BORDER, previous + 1, previous).tolist()
    border, to = (np.array(starts) + left[starts]).tolist(), ends.tolist()
    for b, start in enumerate(starts):
        if to[b] - start < MIN_RUN:
            runs[to[b] - start].add(start)
        for way in (1, -1):  # rows of blocks forward from this one, and backward to it
            e = b
            while 0 <= e < len(starts) and border[e] == border[b]:
                i, j = (start, to[e]) if way == 1 else (starts[e], to[b])
                if j - i >= MIN_RUN:
                    if j - i < LONG:
                        runs[j - i].add(i)
                    break
                e += way
    return {LONG: np.flatnonzero(left >= LONG), **{size: np.array(sorted(at), np.int64) for size, at in runs.items() if at}}


def repeats(tokens: np.ndarray, ends: np.ndarray, page: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, first place, pages) of each distinct run, from the suffix array of the streams in a block; ``page`` is that of each place."""
    order, common, left = suffix_array(tokens)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    for size, at in _runs(tokens, ends, left).items():
        if not len(at):
            continue
        same = np.cumsum(common < size)[place[at]]  # neighbours with ``size`` tokens in common
        pairs = np.unique(np.stack([same, page[at]]), axis=1)[0]
        group, first = np.unique(same, return_index=True)
        kind = RUN if size == LONG else SHORT if size < MIN_RUN else WHOLE
        for i, pages in zip(at[first].tolist(), np.bincount(np.searchsorted(group, pairs)).tolist()):
            key = 0
            for token in tokens[i : i + size].tolist():
                key = (key * _BASE + token) % _PRIME
            yield key * 4 + kind, i, pages


def _sorted_block(table: pa.Table) -> pa.Table:
    """Runs of the pages of a block with the number of pages; of a page in parts, with the page."""
    lists = [np.array(t, np.int64) for t in table.column("tokens").to_pylist()]
    sizes = [len(t) for t in lists]
    offsets = np.cumsum([0, *sizes[:-1]])
    ends = np.concatenate([np.array(e, np.int64) + o for e, o in zip(table.column("ends").to_pylist(), offsets)])
    own = table.column("page").to_numpy()
    found = list(repeats(np.concatenate(lists), ends, np.repeat(own, sizes)))
    page = int(own[0]) if table.column("part")[0].as_py() else -1
    columns = ([table.column("host")[0].as_py()] * len(found), [k for k, _, _ in found], [page] * len(found), [p for _, _, p in found])
    return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("host", "key", "page", "pages"), columns)})


def run_counts(streams: DataFrame) -> DataFrame:
    """host, key and pages of all runs. A host's pages are dealt to blocks of about BLOCK_TOKENS by their main text, a page whose
    variants are more than that to parts; each block has its own suffix array, and as no page is in two blocks, counts add up."""
    n = F.size("tokens")
    hosts = streams.groupBy("host").agg(F.ceil(F.sum(n) / BLOCK_TOKENS).alias("blocks"))
    large = streams.groupBy("host", "page").agg(F.ceil(F.sum(n) / BLOCK_TOKENS).alias("parts")).where("parts > 1")
    placed = streams.join(hosts, "host").join(large, ["host", "page"], "left")
    dealt = placed.select(
        "host", "page", "tokens", "ends",
        F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("page"), "blocks")).otherwise(F.col("page")).alias("block"),
        F.when(F.col("parts").isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64("row"), "parts") + 1).alias("part"),
    )
    found = dealt.groupBy("host", "block", "part").applyInArrow(_sorted_block, "host long, key long, page long, pages long")
    once = found.groupBy("host", "key", "page").agg(F.sum("pages").alias("n")).withColumn("n", F.when(F.col("page") == -1, F.col("n")).otherwise(F.lit(1)))
    return once.groupBy("host", "key").agg(F.sum("n").alias("pages"))


PARSED = "host long, page long, row long, text string, roles array<int>, texts array<string>, tokens array<long>, ends array<int>"


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page with its host, its text if structure settles it, else its blocks, and the tokens of what is outside articles."""
    kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32())]
    for rows in batches:
        out: list[list] = [[] for _ in kinds]
        for url, html in zip(rows.column("url").to_pylist(), rows.column("html").to_pylist()):
            found = blocks(html or "")
            is_open = any(role == OPEN for role, _ in found)
            text = None if is_open else unique_text(found, set())
            roles, texts = ([r for r, _ in found], [t for _, t in found]) if is_open else (None, None)
            for column, value in zip(out, (_number(host_of(url)), _page(found), _page(found, True), text, roles, texts, *_stream(found))):
                column.append(value)
        arrays = [rows.column("page_id"), rows.column("url"), *(pa.array(c, k) for c, k in zip(out, kinds))]
        yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "host", "page", "row", "text", "roles", "texts", "tokens", "ends"])


def _looked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All keys of pages with open blocks, partly covered blocks included."""
    for rows in batches:
        keys = [_keys(list(zip(r, t)), True) for r, t in zip(rows.column("roles").to_pylist(), rows.column("texts").to_pylist())]
        yield pa.RecordBatch.from_arrays([rows.column("host"), rows.column("row"), pa.array(keys, pa.list_(pa.int64()))], names=["host", "row", "keys"])


def _finished(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        _, _, roles, texts, covered = (c.to_pylist() for c in b.columns)
        done = [unique_text(list(zip(r, t)), set(c or ())) for r, t, c in zip(roles, texts, covered)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(done, pa.string())], names=["page_id", "url", "text"])


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``. Each page is parsed once, into a table in
    the shared folder."""
    rows = pages.select("page_id", "url", "html")
    kind = rows.schema["page_id"].dataType.simpleString()
    parsed = stored(rows.mapInArrow(_parsed, f"page_id {kind}, url string, {PARSED}"), "pages-parsed")
    settled = parsed.where(F.col("text").isNotNull()).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
    opened = parsed.where(F.col("text").isNull())
    if opened.isEmpty():  # nothing is left to decide
        return settled
    streams = parsed.where(F.size("ends") > 0).select("host", "page", "row", "tokens", "ends").join(opened.select("host").distinct(), "host", "left_semi").dropDuplicates(["host", "row"])
    salted = run_counts(streams).where(F.col("pages") >= 2).withColumn("salt", F.pmod("key", F.lit(_SALTS)))
    of = streams.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("of"))
    hosts = of.select("host", "of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))).alias("salt"))
    share = F.when(F.col("key").bitwiseAND(3) == SHORT, SHORT_SHARE).otherwise(SHARE)
    repeated = salted.join(hosts, ["host", "salt"]).where(F.col("pages") >= F.greatest(F.least(F.lit(min_pages), "of"), F.ceil(F.col("of") * share))).select("host", "key")

    own = opened.select("host", "row", "roles", "texts").mapInArrow(_looked, "host long, row long, keys array<long>")
    hits = own.select("host", "row", F.explode("keys").alias("key")).join(repeated, ["host", "key"]).groupBy("host", "row").agg(F.collect_set("key").alias("covered"))
    decided = opened.join(hits, ["host", "row"], "left").select("page_id", "url", "roles", "texts", "covered")
    rest = decided.mapInArrow(_finished, f"page_id {kind}, url string, text string")
    return settled.unionByName(rest.withColumn("n_chars", F.char_length("text").cast("long")))
