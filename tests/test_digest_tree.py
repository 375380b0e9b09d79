"""Trees of digests: plain digest of short lists, bounded groups, differences found without reading equal parts."""

import hashlib
from pathlib import Path, PurePosixPath

import pytest
from pyspark.sql import functions as F

from rankloom.operators import digest_tree as T

SCHEMA = "path STRING, sha256 STRING"


def digest(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def plain(files):
    """The digest over sorted paths and raw content digests."""
    whole = hashlib.sha256()
    for path in sorted(files, key=lambda p: PurePosixPath(p).parts):
        whole.update(path.encode())
        whole.update(bytes.fromhex(files[path]))
    return whole.hexdigest()


def fingerprint(spark, rows, **options):
    return T.tree_fingerprint(spark.createDataFrame(rows, SCHEMA).repartition(5), **options).first()


def test_a_short_list_has_the_plain_digest(spark):
    files = {p: digest(t) for p, t in {"a/b": "1", "a-b": "2", "a": "3", "ä/z": "4"}.items()}
    assert fingerprint(spark, list(files.items())).fingerprint == plain(files)
    assert tuple(fingerprint(spark, [])) == (0, hashlib.sha256().hexdigest())


def test_order_does_not_matter_and_changes_do(spark):
    rows = [(f"d{i % 9}/f{i}", digest(str(i))) for i in range(400)]
    take = lambda r: fingerprint(spark, r, leaf=16, fanout=4)
    base = take(rows)
    assert base.files == 400
    assert take(rows[::-1]) == base
    for other in ([("d0/g0", rows[0][1])] + rows[1:], [(rows[0][0], digest("x"))] + rows[1:]):
        assert take(other).fingerprint != base.fingerprint


def rebuilt(files, leaf, fanout):
    """The tree in plain Python: [(level, key, files, digest)]."""

    def runs(items, level, each):
        out, start = [], 0
        for i, (key, _, _) in enumerate(items):
            salted = key if level == 0 else f"{key}#{level}"
            own = len(items) > each and int(digest(salted)[:8], 16) % each == 0
            if i and (own or i - start == T.LONGEST * each):
                out.append(items[start:i])
                start = i
        return out + [items[start:]]

    items = [(p, 1, p.encode() + bytes.fromhex(files[p])) for p in sorted(files, key=lambda p: p.split("/"))]
    nodes, level, each = [], 0, leaf
    while True:
        items = [(r[0][0], sum(x[1] for x in r), hashlib.sha256(b"".join(x[2] for x in r)).digest()) for r in runs(items, level, each)]
        nodes += [(level, k, n, d.hex()) for k, n, d in items]
        if len(items) == 1:
            return set(nodes)
        level, each = level + 1, fanout


@pytest.mark.parametrize("n,leaf,fanout", [(1, 4, 2), (4, 4, 2), (300, 8, 4), (300, 2, 100), (90, 90, 2)])
def test_tree_equals_the_plain_version(spark, n, leaf, fanout):
    files = {f"d{i % 7}/x{i % 3}/f{i}": digest(str(i)) for i in range(n)}
    tree = T.build_tree(spark.createDataFrame(list(files.items()), SCHEMA), leaf, fanout)
    assert {tuple(r) for r in tree.nodes.select("level", "key", "files", "digest").collect()} == rebuilt(files, leaf, fanout)
    # every node but the root has its parent one level above, every file its leaf
    pairs = {(r.level, r.key): r.parent for r in tree.nodes.collect()}
    assert all((level + 1, parent) in pairs for (level, _), parent in pairs.items() if parent) and list(pairs.values()).count(None) == 1
    assert {r.leaf for r in tree.entries.collect()} == {k for level, k in pairs if level == 0}


def test_groups_are_bounded(spark):
    """200,000 paths, and 30,000 that no path's digest cuts: no group is longer than the bound."""
    leaf, fanout = 64, 16
    many = spark.range(200_000).select(F.concat(F.lit("a/"), F.col("id") % 100, F.lit("/f"), "id").alias("path"), F.sha2(F.col("id").cast("string"), 256).alias("sha256"))
    uncut = spark.range(40_000).select(F.concat(F.lit("b/f"), "id").alias("path"), F.lit(digest("one")).alias("sha256")).where(~T.begins(F.col("path"), 0, leaf))
    tree = T.build_tree(many.unionByName(uncut), leaf, fanout)
    leaves = tree.nodes.where("level = 0")
    assert leaves.agg(F.max("files"), F.sum("files")).first() == (T.LONGEST * leaf, tree.entries.count())
    children = tree.nodes.where("parent IS NOT NULL").groupBy("level", "parent").count()
    assert children.agg(F.max("count")).first()[0] <= T.LONGEST * fanout
    assert tree.top >= 3 and tree.nodes.where(F.col("level") == tree.top).count() == 1
    assert tree.entries.groupBy("slice").count().count() <= T.SLICES


def changed(spark, rows, **edits):
    files = dict(rows)
    files.update(edits.get("put", {}))
    for path in edits.get("drop", ()):
        del files[path]
    return spark.createDataFrame(list(files.items()), SCHEMA)


ROWS = [(f"d{i % 50}/f{i}", digest(str(i))) for i in range(2000)]


@pytest.fixture(scope="module")
def base(spark):
    return T.build_tree(spark.createDataFrame(ROWS, SCHEMA), 32, 8)


@pytest.mark.parametrize(
    "edits",
    [
        {"drop": ["d0/f0", "d9/f59"], "put": {"d7/f7": digest("new"), "d10/added": digest("a"), "zz/last": digest("z"), "a/first": digest("f")}},
        {"drop": [p for p, _ in ROWS[20:]]},
        {"drop": [p for p, _ in ROWS]},
    ],
)
def test_differences(spark, base, edits):
    df = changed(spark, ROWS, **edits)
    after = T.build_tree(df, 32, 8)
    old, new = dict(ROWS), {r.path: r.sha256 for r in df.collect()}
    kind = lambda p: "added" if p not in old else "removed" if p not in new else "changed"
    want = {(p, kind(p), old.get(p), new.get(p)) for p in old.keys() | new.keys() if old.get(p) != new.get(p)}
    assert {tuple(r) for r in T.tree_diff(base, after).collect()} == want
    turned = {(p, {"added": "removed", "removed": "added"}.get(k, k), b, a) for p, k, a, b in want}
    assert {tuple(r) for r in T.tree_diff(after, base).collect()} == turned


def test_equal_trees_have_no_difference(base):
    assert T.tree_diff(base, base).count() == 0


def test_equal_parts_are_not_read(spark, base, tmp_path):
    """A stored tree whose other entries can't be read any more still gives the difference."""
    folder = str(tmp_path / "tree")
    T.write_tree(base, folder)
    after = T.build_tree(changed(spark, ROWS, put={"d7/f7": digest("new")}), 32, 8)
    before = T.read_tree(spark, folder)
    assert before.root().first() == base.root().first()
    held = before.entries.where("path = 'd7/f7'").first().slice
    broken = 0
    for file in Path(folder, "entries").rglob("*.parquet"):
        if file.parent.name != f"slice={held}":
            file.write_bytes(b"not a file")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
            broken += 1
    assert broken > 20
    assert [tuple(r) for r in T.tree_diff(before, after).collect()] == [("d7/f7", "changed", digest("7"), digest("new"))]
