from collections import Counter

from rankloom.llm.decontamination import decontaminate, overlaps
from rankloom.llm.html_text import blocks, main_text, unique_text
from rankloom.llm.license_scan import TEMPLATES, license_scan
from tests.llm.edge import documents, empty, prose

ITEM = prose(77, 40)


def edited(text: str, every: int) -> str:
    return " ".join("zzz" if k % every == every - 1 else w for k, w in enumerate(text.split()))


def test_leaks(spark):
    clean = [(k, prose(200 + k, 60)) for k in range(6)]
    leaks = [(10, f"{prose(1, 30)} {ITEM.upper()} tail"), (11, ITEM), (12, f"Intro. {edited(ITEM, 5)} end"), (13, f"{edited(ITEM, 4)}"), (14, " ".join(ITEM.split()[8:30])), (15, f"a {edited(ITEM, 3)} b")]
    odd = [(20, None), (21, ""), (None, ITEM), (22, "few words"), (11, ITEM), (23, " ".join(ITEM.split()[:6]))]
    docs = spark.createDataFrame([(k, t, "c") for k, t in clean + leaks + odd], "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame([(1, ITEM), (2, prose(99, 30)), (3, None), (4, ""), (5, "too short"), (1, ITEM), (None, prose(98, 20))], "item_id long, text string")
    found = overlaps(docs, bench).collect()
    assert Counter((r["doc_id"], r["item_id"]) for r in found) == Counter({(k, 1): 1 for k in (10, 11, 12, 13, 14, 15, None)})
    full = next(r for r in found if r["doc_id"] == 10)
    assert (full["score"], full["matched"], full["item_tokens"], full["doc_start"]) == (40, 40, 40, 30)
    kept = decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 20, 21, 22, 23]
    assert overlaps(docs, bench.limit(0)).count() == 0 and overlaps(docs.limit(0), bench).count() == 0
    assert decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_leaks_without_broadcast(spark, monkeypatch):
    from rankloom.llm import decontamination

    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    test_leaks(spark)


def test_licenses(spark):
    texts = [
        (1, f"{prose(1, 30)}\n{TEMPLATES[0][1]}"),
        (2, f"{prose(2, 30)}\nLicensed under CC BY 4.0.\n{prose(3, 9)}\nLicensed under CC BY-NC 4.0."),
        (3, "This work is licensed under the GNU General Public License version 3. More of it."),
        (4, "This work is licensed under the GNU General Public License, version 9."),
        (5, "My driving license is new; ask for permission."),
        (6, None),
        (7, ""),
        (None, TEMPLATES[2][1]),
        (8, "x " * 5000 + "\n" + TEMPLATES[1][1].upper()),
    ]
    docs = spark.createDataFrame([(k, t, "c") for k, t in texts], "doc_id long, text string, license string")
    found = Counter((r["doc_id"], r["license"], r["verdict"]) for r in license_scan(docs).collect())
    assert found == Counter(
        {(1, "MIT", "exact"): 1, (2, "CC-BY-4.0", "exact"): 1, (2, "CC-BY-NC-4.0", "exact"): 1, (3, "GPL-3.0", "exact"): 1, (None, "Apache-2.0", "exact"): 1, (8, "MIT", "exact"): 1}
    )
    assert license_scan(documents(spark)).count() == 0 == license_scan(empty(spark)).count()


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header>Site name</header><nav><ul><li><a href=/a>One</a></li></ul></nav><div class="cookie-notice">We use <b>cookies</b></div>
<aside>Side</aside><!-- <p>hidden</p> --><ARTICLE><h1>Caf&eacute; &amp; more</h1><p>First <i>in</i>side&nbsp;text<br>second<p>Third &lt;b&gt;
<form><input value="x">Sign up<button>Go</button></form><figure><figcaption>Picture</figcaption></figure><ul><li>a<li>b</ul></ARTICLE>
<section id="comments"><article class="comment"><p>Nice!</p></article></section><footer>&copy; 2024</footer></body></html>"""


def test_blocks():
    assert unique_text(blocks(PAGE), set()) == "Café & more First inside text second Third <b> Picture a b"
    assert blocks("") == [] and unique_text(blocks("plain <b>words</b> &#8217;"), set()) == "plain words ’"
    assert unique_text(blocks("<p>open <nav>menu<p>body"), set()) == "open"
    assert unique_text(blocks("<div class=ad>buy</div>kept<script>never closed"), set()) == "kept"


def test_class_words_do_not_delete_articles():
    text = lambda html: unique_text(blocks(html), set())
    inside = lambda html: text(f"<article><p>Begin.</p>{html}<p>End.</p></article>")
    assert text('<div class="social-network-theme"><article>Main text.</article></div>') == "Main text."
    assert text('<main><div class="share-price">Shares rose.</div></main>') == "Shares rose."
    for kept in ('<h2 id="related-work">Work.</h2>', '<h2 id="social-history">Work.</h2>', '<p class="notice">Work.</p>', '<section id="menu-design"><p>Work.</p></section>'):
        assert inside(kept) == "Begin. Work. End."
    for dropped in ('<div class="share-buttons">Share</div>', '<div class="ad">Buy</div>', '<div id="related-posts"><a>More</a></div>', "<nav>Menu</nav>", '<div class="social links">x</div>', '<div class="ad-slot-3">y</div>'):
        assert inside(dropped) == "Begin. End."
    wrapped = '<div class="widget"><article><p>Main text.</p></article></div>'
    assert text(wrapped) == "Main text." and text(f"<article>Own.</article>{wrapped}") == "Own."
    assert text('<div class="comments"><article>Nice!</article></div><div>Open.</div>') == "Open."


def plain_main_text(pages):
    """Every run of five tokens outside articles is looked up on every other page of the host."""
    from rankloom.llm.html_text import DROP, KEEP, host_of

    def stream(html):
        out = []
        for role, text in blocks(html or ""):
            out += ["\0"] if role == KEEP else text.split()
        return out

    streams = {(k, u): stream(h) for k, u, h in pages}
    result = Counter()
    for k, u, h in pages:
        tokens = streams[k, u]
        covered = [False] * len(tokens)
        for i in range(len(tokens) - 4):
            run = tokens[i : i + 5]
            on = {k2 for (k2, u2), t in streams.items() if host_of(u2) == host_of(u) and any(t[j : j + 5] == run for j in range(len(t) - 4))}
            if "\0" not in run and len(on) >= 3:
                covered[i : i + 5] = [True] * 5
        out, at = [], 0
        for role, text in blocks(h or ""):
            if role == KEEP:
                out.append(text)
                at += 1
                continue
            own = text.split()
            out += [w for w, c in zip(own, covered[at:]) if not c] if role != DROP else []
            at += len(own)
        result[k, u, " ".join(out)] += 1
    return result


def test_hosts(spark):
    menu, foot = "Home News Sports Weather About Contact", "All rights reserved by the example site"
    pages = [(k, f"https://a.example/{k}", f"<div>{menu}</div><div>{prose(k, 20)}</div><div>{foot}</div>") for k in range(5)]
    pages += [(10, "https://b.example/1", f"<div>{menu}</div><div>{prose(30, 20)}</div>"), (11, "http://A.example:80/x", f"<p>{menu} {prose(40, 12)}</p>")]
    pages += [(12, None, None), (13, "https://a.example/e", ""), (14, "https://c.example", PAGE), (None, "https://a.example/n", "<p>alone here</p>"), (14, "https://c.example", PAGE)]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, text string").repartition(3)
    found = main_text(df).collect()
    assert Counter((r["page_id"], r["url"], r["text"]) for r in found) == plain_main_text(pages)
    by_id = {r["page_id"]: r for r in found}
    assert by_id[0]["text"] == prose(0, 20) and by_id[10]["text"].startswith("Home") and by_id[0]["n_chars"] == len(prose(0, 20))
    assert main_text(df.limit(0)).count() == 0


def test_large_host_keeps_common_phrases_and_copies(spark):
    def own(k, n):
        return " ".join(f"w{k}x{i}" for i in range(n))

    phrase, menu, notice = "at the end of the", "<div>Home</div><div>News</div><div>Sports and more</div>", " ".join(f"notice{i}" for i in range(24))
    article = own("a", 80)
    host = "https://big.example"
    pages, expected = [], {}
    for k in range(120):
        text = f"{own(k, 12)} {phrase} {own(-k - 1, 9)}" if k % 2 else own(k, 25)
        inside = f" {notice} {own(k + 1000, 4)}" if k % 3 == 0 else ""
        pages.append((k, f"{host}/{k}", f"{menu}<p>{text}{inside}</p><div>Share this</div>"))
        expected[k] = text + (f" {own(k + 1000, 4)}" if inside else "")
    for k in range(200, 203):
        pages.append((k, f"{host}/{k}", f"{menu}<p>{article}</p><p>at {own(k, 3)}</p>"))
        expected[k] = f"{article} at {own(k, 3)}"
    for k in range(300, 303):  # the only pages of their host
        pages.append((k, f"https://copies.example/{k}", f"<p>{article}</p>"))
        expected[k] = article
    for k in range(400, 402):
        pages.append((k, f"https://two.example/{k}", f"<div>one two three four five six</div><p>{own(k, 8)}</p>"))
        expected[k] = own(k, 8)
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    assert {r["page_id"]: r["text"] for r in main_text(df).collect()} == expected


def test_wrapped_notices():
    import textwrap

    from rankloom.llm.license_scan import Scanner

    scanner = Scanner()
    for name, text in TEMPLATES:
        for width in (60, 70, 80):
            for mark in ("", "# ", "// ", " * "):
                wrapped = "\n".join(mark + line for line in textwrap.wrap(text, width, break_on_hyphens=False))
                found = list(scanner.matches(f"{prose(1, 30)}\n\n{wrapped}\n{mark.rstrip()}\n{prose(2, 60)}"))
                assert [(m[3], m[-1]) for m in found] == [(name, "exact")], (text, width, mark)
    mpl = TEMPLATES[9][1].replace("Mozilla Public ", "Mozilla Public\n")
    far = "\n".join([mpl, prose(3, 20), prose(4, 20), prose(5, 20), mpl])
    assert [(m[1], m[2], m[3]) for m in scanner.matches(far)] == [(0, 1, "MPL-2.0"), (5, 6, "MPL-2.0")]


def test_every_template_is_tried():
    from rankloom.llm.license_scan import Scanner

    scanner = Scanner()
    none = "This work is licensed under the GNU General Public License, version 1."
    for k in (0, 2, 12):
        assert [(m[3], m[-1]) for m in scanner.matches(f"{none}\n{TEMPLATES[k][1]}")] == [(TEMPLATES[k][0], "exact")]
    two = f"{none} {prose(1, 16)} The work is licensed under the GNU General Public License, version 2."
    assert [(m[3], m[8], m[9]) for m in scanner.matches(two)] == [("GPL-2.0", "this", "")]


def test_suffix_array_counts_runs(spark, monkeypatch):
    import random

    import numpy as np

    from rankloom.llm import html_text as H

    rng = random.Random(5)
    words = ["ab", "cd", "ef", "gh"]
    long_ones = [" ".join(f"l{k}x{i}" for i in range(23)) for k in range(2)]

    def page():
        return [(rng.choice([H.OPEN, H.OPEN, H.DROP, H.KEEP]), rng.choice(long_ones) if rng.random() < 0.2 else " ".join(rng.choices(words, k=rng.randint(1, 9)))) for _ in range(rng.randint(1, 6))]

    pages = [p for p in (page() for _ in range(60)) if H._stream(p)[1]]
    streams = [H._stream(p) for p in pages]
    tokens, sizes = np.concatenate([np.array(t, np.int64) for t, _ in streams]), [len(t) for t, _ in streams]
    order, common, left = H.suffix_array(tokens)
    suffix = [tuple(tokens[i : i + min(int(left[i]), H.LONG)].tolist()) for i in order]
    number = {t: k for k, t in enumerate(np.unique(tokens).tolist())}
    assert [[number[t] for t in s] for s in suffix] == sorted([number[t] for t in s] for s in suffix)
    for before, after, n in zip(suffix, suffix[1:], common[1:].tolist()):
        assert n == next((k for k, (x, y) in enumerate(zip(before, after)) if x != y), min(len(before), len(after)))

    expected: Counter = Counter()
    for p in pages:  # rows of whole blocks of LONG tokens or more are covered by their runs of LONG
        expected.update({k for k, i, j in H._occurrences(p) if k % 4 != H.WHOLE or j - i < H.LONG})
    ends = np.concatenate([np.array(e) + o for (_, e), o in zip(streams, np.cumsum([0, *sizes[:-1]]))])
    assert {k: n for k, _, n in H.repeats(tokens, ends, np.repeat(np.arange(len(pages)), sizes))} == expected

    rows = [(7, k // 2, k, *s) for k, s in enumerate(streams)]  # two variants of each page
    merged: Counter = Counter()
    for k in range(0, len(pages), 2):
        merged.update({x for p in pages[k : k + 2] for x, i, j in H._occurrences(p) if x % 4 != H.WHOLE or j - i < H.LONG})
    df = spark.createDataFrame(rows, "host long, page long, row long, tokens array<long>, ends array<int>")
    for most in (1 << 18, 100, 20):  # one block, several, pages in parts
        monkeypatch.setattr(H, "BLOCK_TOKENS", most)
        assert {r.key: r.pages for r in H.run_counts(df).collect()} == merged
