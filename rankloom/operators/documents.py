"""Localized documents against their sources: structure, script, length and hash rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom import params as P
from rankloom.functions import text as X
from rankloom.functions.blocks import nested_structure
from rankloom.functions.markdown import fence_blocks, headings_in, open_fence_in, prose_in, without_fences
from rankloom.functions.scalars import slug, violations
from rankloom.session import small_batches, stored


def with_shape(df: DataFrame, text: Column, name: str, where: Column | None = None) -> DataFrame:
    """Add ``name``, the structure of nested blocks (null where linear patterns do), and ``name_bare``, the text without fences."""
    shape = nested_structure(text if where is None else F.when(where, text))
    return small_batches(df).withColumn(name, shape).withColumn(f"{name}_bare", F.when(F.col(name).isNull(), without_fences(text)))


def blocks_of(name: str, text: Column) -> Column:
    return F.when(F.col(name).isNotNull(), F.col(f"{name}.blocks")).otherwise(fence_blocks(text))


def levels_of(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), F.col(f"{name}.headings")).otherwise(headings_in(F.col(f"{name}_bare")))


def prose_of(name: str) -> Column:
    return prose_in(F.coalesce(f"{name}.prose", f"{name}_bare"))


def unclosed_in(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), F.col(f"{name}.unclosed")).otherwise(open_fence_in(F.col(f"{name}_bare")))


def markdown_structure(df: DataFrame, text: str) -> DataFrame:
    """Add ordered fence blocks, heading levels, prose and the unclosed-fence flag.

    Texts whose blocks are nested (in lists, quotes, raw HTML) go through the state machine of
    ``functions.blocks``; linear patterns do for all others."""
    shaped = with_shape(df, F.col(text), "_shape")
    parts = {
        "blocks": blocks_of("_shape", F.col(text)),
        "headings": levels_of("_shape"),
        "prose": prose_of("_shape"),
        "unclosed": unclosed_in("_shape"),
    }
    return shaped.withColumns(parts).drop("_shape", "_shape_bare")


def with_parts(df: DataFrame, mode: str, body: str, source: str, script: str) -> DataFrame:
    """Add what the structure and prose rules compare, each part computed once per row.

    A copy needs its source's prose, a translation needs blocks and headings of both sides;
    the other parts are left null.
    """
    copy, b, s = F.col(mode) == P.MODE_COPY, F.col(body), F.col("_source")
    own, other = "_own", "_other"
    known = df.withColumns({"_source": X.unix_lines(F.col(source)), "_copy": copy})
    shaped = with_shape(with_shape(known, b, own, ~F.col("_copy")), s, other)
    translated = lambda part: F.when(~F.col("_copy"), part)
    return shaped.withColumns(
        {
            "_levels": translated(levels_of(own)),
            "_source_levels": translated(levels_of(other)),
            "_same_blocks": translated(blocks_of(own, b) == blocks_of(other, s)),
            "_prose": F.when(F.col("_copy"), prose_of(other)),
            "_native": X.script_chars(b, script),
            "_source_native": F.when(F.col("_copy"), X.script_chars(s, script)),
        }
    ).withColumns({"_prose_native": X.script_chars(F.col("_prose"), script), "_words": X.latin_words(F.col("_prose"))})


def structure_rules(body: Column) -> list[tuple[Column, str]]:
    """A copy equals its source, whose prose is mostly in the script. A translation keeps
    code blocks and headings; it may add one first-level heading in front."""
    c = F.col
    same_levels = (c("_levels") == c("_source_levels")) | (
        c("_levels") == F.concat(F.array(F.lit(1)), c("_source_levels"))
    )
    return [
        (unclosed_in("_other") | (~c("_copy") & unclosed_in("_own")), "unclosed_fence"),
        (c("_copy") & (c("_prose_native") < F.greatest(F.lit(1), c("_words"))), "copy_not_native"),
        (c("_copy") & (body != X.strip(c("_source"))), "copy_differs"),
        (~c("_same_blocks"), "code_blocks"),
        (~c("_copy") & ~same_levels, "headings"),
    ]


def structure_diff(
    pairs: DataFrame, body: str = "body", source: str = "source", mode: str = "mode", script: str = P.NATIVE_SCRIPT
) -> DataFrame:
    parts = with_parts(pairs, mode, body, source, script)
    checked = parts.withColumn("violations", violations(*structure_rules(F.col(body))))
    return checked.select(*pairs.columns, "violations")


def prose_rules(
    body: Column, minimum: int = P.NATIVE_CHARS_MIN, run: int = P.DOCUMENT_FOREIGN_RUN_MIN
) -> list[tuple[Column, str]]:
    c = F.col
    needed = F.when(c("_copy"), F.least(F.lit(minimum), c("_source_native"))).otherwise(F.lit(minimum))
    return [
        (~c("_copy") & ~body.rlike("(?m)^# .+"), "no_title"),
        (c("_native") < needed, "too_little_native"),
        (X.has_foreign_passage(body, run), "foreign_passage"),
        (X.has_placeholder(body), "placeholder"),
        (X.odd_fences(body), "odd_fences"),
    ]


def length_rules(mode: Column, body: Column, source_bytes: Column, declared_bytes: Column) -> list[tuple[Column, str]]:
    short = (F.coalesce(source_bytes, F.lit(0)) > 0) & (declared_bytes < source_bytes * P.LENGTH_RATIO_MIN)
    return [
        (F.coalesce(declared_bytes, F.lit(0)) != F.octet_length(body), "translation_bytes"),
        ((mode == P.MODE_TRANSLATION) & short, "too_short"),
    ]


def localized_rows(manifest: DataFrame, files: DataFrame, sources: DataFrame) -> DataFrame:
    """Manifest rows with the text of their file and of their source, and the parsed frontmatter.

    ``files`` and ``sources`` are (path, text); paths are unique, so both lookups are.
    """
    digest = F.lower("source_sha256")
    rows = (
        manifest.withColumn("digest", digest)
        .withColumn("expected_source", F.concat(F.lit("readmes/sources/"), digest, F.lit(".md")))
        .withColumn("expected_path", F.concat(F.lit("readmes/"), slug(F.col("full_name")), F.lit(f".{P.LOCAL_LANGUAGE}.md")))
    )
    joined = rows.join(
        files.select(F.col("path").alias("expected_path"), F.col("text").alias("document")), "expected_path", "left"
    ).join(sources.select(F.col("path").alias("expected_source"), F.col("text").alias("source")), "expected_source", "left")
    parsed = joined.withColumn("entries", X.frontmatter_entries(F.col("document"))).withColumn(
        "body", X.frontmatter_body(F.col("document"))
    )
    for key in P.FRONTMATTER_KEYS:
        parsed = parsed.withColumn(f"meta_{key}", X.frontmatter_value(F.col("entries"), key))
    return parsed


def document_rules(language: str = P.LOCAL_LANGUAGE, run: int = P.DOCUMENT_FOREIGN_RUN_MIN) -> list[tuple[Column, str]]:
    c = F.col
    mode, body = c("meta_mode"), c("body")
    present = c("document").isNotNull() & X.frontmatter_complete(c("entries"))
    header = [
        (c("document").isNull(), "file_missing"),
        (c("document").isNotNull() & ~X.frontmatter_complete(c("entries")), "frontmatter"),
        (c("translation") != c("expected_path"), "translation_path"),
        (c("source_artifact") != c("expected_source"), "source_path"),
        (F.lower("translation_sha256") != F.sha2("document", 256), "translation_sha256"),
        (c("meta_full_name") != c("full_name"), "full_name"),
        (c("meta_source_url") != c("source_url"), "source_url"),
        (F.lower("meta_source_sha256") != c("digest"), "source_sha256"),
        (~F.lower("meta_source_sha256").rlike("^[0-9a-f]{64}$"), "source_sha256_shape"),
        (c("meta_language") != language, "language"),
        (~c("meta_mode").isin(P.MODE_COPY, P.MODE_TRANSLATION), "mode"),
        (F.coalesce(c("mode"), mode) != mode, "mode_differs"),
        (c("source").isNull(), "source_missing"),
        (F.sha2("source", 256) != c("digest"), "source_changed"),
        (F.coalesce("source_bytes", F.lit(-1)) != F.octet_length("source"), "source_bytes"),
    ]
    content = (
        structure_rules(body)
        + prose_rules(body, run=run)
        + length_rules(mode, body, c("source_bytes"), c("translation_bytes"))
    )
    return header + [(present & condition, name) for condition, name in content]


def checked_documents(
    manifest: DataFrame, files: DataFrame, sources: DataFrame, script: str = P.NATIVE_SCRIPT, run: int = P.DOCUMENT_FOREIGN_RUN_MIN
) -> DataFrame:
    """Every manifest row with what it breaks by itself: full_name, expected_path, body_sha256, rules. The texts are gone
    over once; what stays is a narrow table in the shared folder."""
    rows = with_parts(localized_rows(manifest, files, sources), "meta_mode", "body", "source", script)
    rules = violations(*document_rules(run=run)).alias("rules")
    return stored(rows.select("full_name", "expected_path", F.sha2("body", 256).alias("body_sha256"), rules), "localized")


def localized_validation(
    manifest: DataFrame, files: DataFrame, sources: DataFrame, script: str = P.NATIVE_SCRIPT, run: int = P.DOCUMENT_FOREIGN_RUN_MIN
) -> DataFrame:
    """All rule violations of every manifest row, repeated names and bodies included."""
    checked = checked_documents(manifest, files, sources, script, run)
    bodies = checked.groupBy("body_sha256").agg(F.count("*").alias("same_body")).where(F.col("same_body") > 1)
    names = checked.groupBy("full_name").agg(F.count("*").alias("same_name")).where(F.col("same_name") > 1)
    joined = checked.join(bodies, "body_sha256", "left").join(names, "full_name", "left")
    repeated = violations(
        (F.col("same_body").isNotNull(), "repeated_body"), (F.col("same_name").isNotNull(), "repeated_name")
    )
    return joined.select("full_name", F.concat("rules", repeated).alias("violations"))


def localized_collection(
    header: DataFrame,
    manifest: DataFrame,
    files: DataFrame,
    sources: DataFrame,
    displayed: DataFrame,
    catalog: DataFrame,
    script: str = P.NATIVE_SCRIPT,
    run: int = P.DOCUMENT_FOREIGN_RUN_MIN,
) -> DataFrame:
    """What keeps the localized documents from being published: (check, item, violations), no row when all is well.

    ``header`` is the manifest's one row (schema_version, entry_count); ``displayed`` and ``catalog`` have full_name.
    Besides the rules on each document, the manifest must list the displayed names once each, these must be in the
    catalog, the files must be the expected ones and no others, and no two bodies may be equal. All these sets are
    compared in one aggregate over tagged keys: a key's rows are counted by side in the tasks that read them, and of
    ``files`` only the paths are read again.
    """
    checked = checked_documents(manifest, files, sources, script, run)

    def side(rows: DataFrame, check: str, item: Column, name: str, n: Column | int = 1) -> DataFrame:
        count = n if isinstance(n, Column) else F.lit(n)
        return rows.select(F.lit(check).alias("check"), item.alias("item"), F.lit(name).alias("side"), count.cast("long").alias("n"))

    name = F.col("full_name")
    tagged = [
        side(checked, "name", name, "entry"),
        side(displayed, "name", name, "displayed"),
        side(catalog, "name", name, "catalog"),
        side(checked, "file", F.col("expected_path"), "entry"),
        side(files, "file", F.col("path"), "file"),
        side(checked.where(F.col("body_sha256").isNotNull()), "body", F.col("body_sha256"), "entry"),
        side(checked, "manifest", F.lit("entry_count"), "entry"),
        side(header, "manifest", F.lit("entry_count"), "declared", F.coalesce("entry_count", F.lit(-1))),
        side(header, "manifest", F.lit("schema_version"), "declared", F.coalesce("schema_version", F.lit(-1))),
    ]
    rows = tagged[0]
    for more in tagged[1:]:
        rows = rows.unionByName(more)
    sides = ("entry", "displayed", "catalog", "file", "declared")
    counted = rows.groupBy("check", "item").agg(*[F.coalesce(F.sum(F.when(F.col("side") == s, F.col("n"))), F.lit(0)).alias(s) for s in sides])
    c = F.col
    is_ = lambda check: c("check") == check
    found = violations(
        (is_("name") & (c("entry") > 1), "repeated_name"),
        (is_("name") & (c("displayed") > 0) & (c("entry") == 0), "entry_missing"),
        (is_("name") & (c("displayed") == 0) & (c("entry") > 0), "not_displayed"),
        (is_("name") & (c("displayed") > 0) & (c("catalog") == 0), "not_in_catalog"),
        (is_("file") & (c("file") == 0), "file_missing"),
        (is_("file") & (c("entry") == 0), "file_extra"),
        (is_("body") & (c("entry") > 1), "repeated_body"),
        ((c("item") == "entry_count") & (c("declared") != c("entry")), "entry_count"),
        ((c("item") == "schema_version") & (c("declared") != P.MANIFEST_VERSION), "schema_version"),
    )
    sets = counted.select("check", "item", found.alias("violations"))
    own = checked.select(F.lit("document").alias("check"), name.alias("item"), c("rules").alias("violations"))
    return sets.unionByName(own).where(F.size("violations") > 0)
