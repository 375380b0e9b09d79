"""Links, outlines and rendered pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions.markup import COMMENT, attribute_in, value_of
from rankloom.functions.rows import unnest
from rankloom.functions.scalars import violations
from rankloom.functions.text import media_tags
from rankloom.functions.urls import absolute_target, directory_of, is_absolute, path_of, resolve_dots, rewrite_matches, unquote
from rankloom.operators.boards import node_text

NOT_MARKUP = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
HREF = attribute_in("a|link", "href")
OUTLINED = rf"(?s){attribute_in('h2', 'id')}(.*?)</(?i:h2)\s*>"
EXTERNAL = r"(?i)^(?:https?:|mailto:|#)"

# Where a Markdown text has link targets. One pattern finds them all in one pass from left to right: an
# image with its target, the target that closes any other link (so an image inside a link needs no rule of
# its own), a definition at the start of a line, and the attributes of embedded HTML.
DESTINATION = r"\(\s*(?:<[^<>\n]*>|[^\s()<>]*(?:\([^\s()]*\)[^\s()<>]*)*)(?:\s[^()]*)?\)"
IMAGE_TARGET = rf"!\[[^\]]*\]{DESTINATION}"
LINK_TARGET = rf"\]{DESTINATION}"
DEFINITION = r"^[ ]{0,3}\[[^\]\n]+\]:[ \t]*(?:<[^<>\n]*>|\S+)"
ATTRIBUTE = r"\b(?:href|src)\s*=\s*(?:\"[^\"]*\"|'[^']*')"
ANY_TARGET = rf"(?im){DEFINITION}|{IMAGE_TARGET}|{LINK_TARGET}|{ATTRIBUTE}"
# Parts of one match: what stands before the target, the target, and what follows it.
DEFINITION_PARTS = r"(?s)^(\s*\[[^\]]+\]:[ \t]*<?)(.*?)(>?)$"
ANGLED_PARTS = r"(?s)^(.*?\]\(\s*<)([^<>]*)(>.*)$"
PLAIN_PARTS = r"(?s)^(.*?\]\(\s*)(\S*?)((?:\s.*)?\))$"
ATTRIBUTE_PARTS = r"(?s)^([^=]*=\s*[\"'])(.*)([\"'])$"
IMAGE_USE = r"!\[([^\]]*)\]\[([^\]]*)\]"


def hrefs(html: Column) -> Column:
    """Distinct non-empty link targets of ``a`` and ``link`` tags, in any spelling, outside comments and scripts."""
    markup = F.regexp_replace(html, NOT_MARKUP, " ")
    found = F.transform(F.regexp_extract_all(markup, F.lit(HREF), F.lit(1)), value_of)
    return F.array_distinct(F.filter(found, lambda h: h.isNotNull() & (h != "")))


def page_links(pages: DataFrame, path: str = "path", html: str = "html") -> DataFrame:
    """(page, href, target): internal links with the path they lead to."""
    links = unnest(pages, hrefs(F.col(html)), "href", F.col(path).alias("page"))
    internal = links.where(~F.col("href").rlike(EXTERNAL))
    target = unquote(path_of(F.col("href")))
    rooted = F.startswith(target, F.lit("/"))
    joined = F.when(rooted, target).otherwise(F.concat(directory_of(F.col("page")), target))
    resolved = F.when(rooted, F.concat(F.lit("/"), resolve_dots(joined))).otherwise(resolve_dots(joined))
    # a link with a query or fragment only leads to the page's own folder
    return internal.where(path_of(F.col("href")) != "").withColumn("target", resolved)


def with_folders(paths: DataFrame, path: str = "path") -> DataFrame:
    """Paths and all folders above them, distinct."""
    parts = F.split(path, "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return paths.select(F.explode(prefixes).alias("target")).distinct()


def broken_links(pages: DataFrame, targets: DataFrame, path: str = "path", html: str = "html") -> DataFrame:
    """Internal links whose resolved target is no known path or folder."""
    return page_links(pages, path, html).join(with_folders(targets, "path"), "target", "left_anti")


def page_outline(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Second-level headings with an id, in any spelling, in page order: (key, position, heading_id, heading)."""
    markup = F.regexp_replace(F.col(html), COMMENT, "")
    ids = F.transform(F.regexp_extract_all(markup, F.lit(OUTLINED), F.lit(1)), value_of)
    texts = F.regexp_extract_all(markup, F.lit(OUTLINED), F.lit(2))
    rows = unnest(pages, F.arrays_zip(ids.alias("id"), texts.alias("text")), "h", key, position="position")
    return rows.select(
        key,
        "position",
        F.col("h.id").alias("heading_id"),
        node_text(F.col("h.text")).alias("heading"),
    )


# --- links of documents ------------------------------------------------------------------------


def _labels_of_images(text: Column) -> Column:
    """Labels that images refer to; an empty label means the image's own text."""
    uses = F.regexp_extract_all(text, F.lit(IMAGE_USE), F.lit(0))

    def label(use: Column) -> Column:
        named = F.regexp_extract(use, IMAGE_USE, 2)
        return F.lower(F.trim(F.when(named == "", F.regexp_extract(use, IMAGE_USE, 1)).otherwise(named)))

    return F.transform(uses, label)


def _described(match: Column, labels: Column) -> Column:
    """A match with its parts, its syntax, and whether its target is shown as an image."""
    defined = F.lower(F.trim(F.regexp_extract(match, r"^\s*\[([^\]]+)\]:", 1)))
    syntax = (
        F.when(match.rlike(r"^ {0,3}\[[^\]]+\]:"), "reference")
        .when(match.rlike(r"(?i)^(?:href|src)"), "html")
        .otherwise("inline")
    )
    image = (
        F.when(syntax == "reference", F.array_contains(labels, defined))
        .when(syntax == "html", F.lower(F.substring(match, 1, 3)) == "src")
        .otherwise(F.startswith(match, F.lit("!")))
    )

    def part(n: int) -> Column:
        inline = F.when(match.rlike(ANGLED_PARTS), F.regexp_extract(match, ANGLED_PARTS, n)).otherwise(F.regexp_extract(match, PLAIN_PARTS, n))
        defined = F.when(syntax == "reference", F.regexp_extract(match, DEFINITION_PARTS, n))
        return defined.when(syntax == "html", F.regexp_extract(match, ATTRIBUTE_PARTS, n)).otherwise(inline)

    return F.struct(syntax.alias("syntax"), part(2).alias("target"), image.alias("image"), part(1).alias("head"), part(3).alias("tail"))


def absolutize_links(
    documents: DataFrame, text: str, full_name: str = "full_name", branch: str = "branch", path: str = "doc_path"
) -> DataFrame:
    """Link table: each distinct target of a document with its absolute form."""
    keys = [full_name, branch, path]
    labelled = documents.select(*keys, F.col(text).alias("_text"), _labels_of_images(F.col(text)).alias("_labels"))
    matches = F.regexp_extract_all("_text", F.lit(ANY_TARGET), F.lit(0))
    rows = unnest(labelled, F.transform(matches, lambda m: _described(m, F.col("_labels"))), "link", *keys)
    absolute = absolute_target(F.col("link.target"), F.col("link.image"), F.col(full_name), F.col(branch), F.col(path))
    table = rows.select(full_name, "link.syntax", "link.target", "link.image", absolute.alias("absolute"))
    return table.where("target <> ''").distinct()


def absolutize_text(
    documents: DataFrame, text: str, full_name: str = "full_name", branch: str = "branch", path: str = "doc_path"
) -> DataFrame:
    """The documents with relative link targets made absolute, all else unchanged, in one pass."""

    def rewritten(match: Column) -> Column:
        d = _described(match, F.col("_labels"))
        absolute = absolute_target(d["target"], d["image"], F.col(full_name), F.col(branch), F.col(path))
        keep = (d["target"] == "") | is_absolute(d["target"])
        return F.when(keep, match).otherwise(F.concat(d["head"], absolute, d["tail"]))

    marked = F.contains("_text", F.lit("](")) | F.contains("_text", F.lit("]:")) | F.col("_text").rlike(r"(?i)(?:href|src)\s*=")
    named = documents.withColumns({"_text": F.col(text), "_labels": _labels_of_images(F.col(text))})
    out = F.when(marked, rewrite_matches(F.col("_text"), ANY_TARGET, rewritten)).otherwise(F.col("_text"))
    return named.withColumn(text, out).drop("_text", "_labels")


# --- rendered pages ----------------------------------------------------------------------------


def rendered_checks(rendered: DataFrame, manifest: DataFrame, section_id: str = P.LOCAL_SECTION_ID) -> DataFrame:
    """Rules on rendered detail pages.

    ``rendered`` is (full_name, html); ``manifest`` is (full_name, source_sha256,
    translation_sha256, body). The embedded section must exist, carry the manifest's hashes
    and its own, keep every live media tag and escape none.
    """
    section = rf'(?s)(<section\b[^>]*\bid="{section_id}"[^>]*>)(.*?)</section>'
    html = F.coalesce("html", F.lit(""))
    joined = manifest.select("full_name", "source_sha256", "translation_sha256", media_tags(F.col("body")).alias("expected"))
    # each step is a column of its own: the rules use the parts many times
    parts = (
        joined.join(rendered, "full_name", "left")
        .withColumns({"opening": F.regexp_extract(html, section, 1), "inner": F.regexp_extract(html, section, 2)})
        .withColumns(
            {
                "rendered": F.regexp_extract("inner", r'(?s)(<div class="localized-readme-body">.*</div>)', 1),
                "embedded": F.col("opening") != "",
                "kept": _tags_in(F.col("inner")),
                "escaped": _escaped_in(F.regexp_replace("inner", r"(?is)<(pre|code)\b.*?</\1\s*>", "")),
            }
        )
        .withColumns({f"_{n.replace('-', '_')}": _attribute(n) for n in ("source-sha256", "translation-sha256", "rendered-sha256")})
    )
    c = F.col
    rules = [
        (~c("embedded"), "section_missing"),
        (c("embedded") & (c("_source_sha256") != c("source_sha256")), "stale_source"),
        (c("embedded") & (c("_translation_sha256") != c("translation_sha256")), "stale_translation"),
        (c("embedded") & (c("_rendered_sha256") != F.sha2("rendered", 256)), "rendered_changed"),
    ]
    for tag in P.MEDIA_TAGS:
        dropped = F.array_contains("expected", tag) & ~F.array_contains("kept", tag)
        rules.append((c("embedded") & dropped, f"dropped_{tag}"))
        rules.append((c("embedded") & F.array_contains("escaped", tag), f"escaped_{tag}"))
    return parts.select("full_name", violations(*rules).alias("violations"))


def _attribute(name: str) -> Column:
    return F.regexp_extract("opening", rf'\bdata-{name}="([^"]*)"', 1)


def _tags_in(html: Column) -> Column:
    names = "|".join(P.MEDIA_TAGS)
    found = F.regexp_extract_all(html, F.lit(rf"(?i)<({names})\b"), F.lit(1))
    return F.array_distinct(F.transform(found, F.lower))


def _escaped_in(html: Column) -> Column:
    names = "|".join(P.MEDIA_TAGS)
    return F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(rf"(?i)&lt;({names})"), F.lit(1)), F.lower))
