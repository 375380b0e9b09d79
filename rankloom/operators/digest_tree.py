"""A tree of digests over the files of a set, and the difference of two trees.

Files are put in path order and cut into leaves; runs of leaves make nodes, runs of nodes make nodes above
them, up to one root. A file begins a new leaf when the digest of its path says so (one in ``leaf`` does), a
node begins a new parent when the digest of its first path does (one in ``fanout``). So the cuts depend on the
paths near them alone: a file that comes or goes changes its leaf and the nodes above it, not the leaves behind
it. A run that chance makes long is cut at ``LONGEST`` times the usual length, which bounds every group.

A leaf's digest is that of its paths and raw content digests, a node's that of its children's digests. A set of
at most ``leaf`` files is one leaf, so its fingerprint is the plain digest of the sorted list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.operators.positions import with_position
from rankloom.session import stored

LEAF = 1024
FANOUT = 256
#: A run is cut after so many times its usual length.
LONGEST = 16
#: Rows over which a running maximum is taken in one task; the offsets have one row for each such stretch.
STRETCH = 1 << 16
#: Entries lie in at most about so many folders, each the files below one node.
SLICES = 1024


@dataclass
class Tree:
    """``nodes``: level (0 the leaves), place, key (the first path), parent (its key), files, digest.
    ``entries``: path, sha256, leaf (its key), slice (a folder)."""

    nodes: DataFrame
    entries: DataFrame
    top: int  #: the root's level; -1 without files
    level: int  #: of the nodes that have a folder of entries each

    def root(self) -> DataFrame:
        """One row: files, fingerprint. The digest of nothing when there is no file."""
        top = self.nodes.where(F.col("level") == self.top)
        nothing = F.sha2(F.lit(b""), 256)
        return top.agg(F.coalesce(F.max("files"), F.lit(0)).alias("files"), F.coalesce(F.max("digest"), nothing).alias("fingerprint"))


def path_order(path: Column) -> Column:
    """Folders sort by their parts, as a listing of the tree does."""
    return F.split(path, "/", -1)


def begins(key: Column, level: int, each: int) -> Column:
    """The digest of ``key`` begins a new run at this level, for one key in ``each``."""
    salted = key if level == 0 else F.concat(key, F.lit(f"#{level}"))
    return F.conv(F.substring(F.sha2(salted, 256), 1, 8), 16, 10).cast("long") % each == 0


def with_run(rows: DataFrame, order: list[Column], starts: Column, each: int, count: int) -> DataFrame:
    """Add ``position``, from 1 in ``order``, and ``run``, the position of the first row of each row's run.

    Up to one stretch of rows is numbered in one task; more are range-sorted, and each stretch takes over where
    the last run of the stretches before it began."""
    own = F.when(starts, F.col("position"))
    if count <= STRETCH:
        numbered = rows.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("long"))
        known = numbered.withColumn("_start", F.coalesce(F.max(own).over(Window.orderBy("position")), F.lit(1)))
    else:
        stretched = with_position(rows, order).withColumn("_stretch", F.floor((F.col("position") - 1) / STRETCH))
        before = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
        carried = stretched.groupBy("_stretch").agg(F.max(own).alias("_last")).select("_stretch", F.max("_last").over(before).alias("_carried"))
        here = F.max(own).over(Window.partitionBy("_stretch").orderBy("position"))
        known = stretched.withColumn("_here", here).join(carried, "_stretch")
        known = known.withColumn("_start", F.coalesce("_here", "_carried", F.lit(1))).drop("_stretch", "_here", "_carried")
    longest = LONGEST * each
    run = F.col("_start") + F.floor((F.col("position") - F.col("_start")) / longest) * longest
    return known.withColumn("run", run.cast("long")).drop("_start")


def _digest(parts: Column) -> Column:
    """SHA-256 over hexadecimal parts (position, hex), in order."""
    return F.sha2(F.unhex(F.array_join(F.transform(F.array_sort(parts), lambda p: p["hex"]), "")), 256)


def _nodes(rows: DataFrame, level: int, files: Column) -> DataFrame:
    """One node for each run of ``rows`` (run, position, key, hex)."""
    return rows.groupBy(F.col("run").alias("place")).agg(
        F.min_by("key", "position").alias("key"), files.cast("long").alias("files"),
        _digest(F.collect_list(F.struct("position", "hex"))).alias("digest"),
    ).select(F.lit(level).alias("level"), "place", "key", "files", "digest")


def build_tree(hashes: DataFrame, leaf: int = LEAF, fanout: int = FANOUT) -> Tree:
    """The tree over (path, sha256), written to the shared folder; paths are unique."""
    spark = hashes.sparkSession
    count = hashes.count()
    starts = begins(F.col("path"), 0, leaf) if count > leaf else F.lit(False)
    order = [path_order(F.col("path")), F.col("path"), F.col("sha256")]
    raw = F.concat(F.lower(F.hex(F.encode("path", "UTF-8"))), F.lower("sha256"))
    files = stored(with_run(hashes.select("path", "sha256"), order, starts, leaf, count), "tree-files")
    below = stored(_nodes(files.withColumns({"hex": raw, "key": F.col("path")}), 0, F.count("*")), "tree-level")
    levels, level, n = [], 0, below.count()
    while n > 1:
        level += 1
        starts = begins(F.col("key"), level, fanout) if n > fanout else F.lit(False)
        runs = with_run(below, [F.col("place")], starts, fanout, n)
        runs = stored(runs.select("level", "place", "key", "files", "digest", "position", "run"), "tree-runs")
        above = stored(_nodes(runs.withColumn("hex", F.col("digest")), level, F.sum("files")), "tree-level")
        levels.append(runs.join(above.select(F.col("place").alias("run"), F.col("key").alias("parent")), "run"))
        below, n = above, above.count()
    levels.append(below.withColumn("parent", F.lit(None).cast("string")))
    nodes = levels[0].select("level", "place", "key", "parent", "files", "digest")
    for more in levels[1:]:
        nodes = nodes.unionByName(more.select(nodes.columns))
    nodes = stored(nodes, "tree-nodes", "level")
    return Tree(nodes, *_entries(spark, files, nodes, level if n else -1))


def _entries(spark: SparkSession, files: DataFrame, nodes: DataFrame, top: int) -> tuple[DataFrame, int, int]:
    """The files by leaf, in one folder for each node of the lowest level that has few enough of them."""
    sizes = {r["level"]: r["count"] for r in nodes.groupBy("level").count().collect()}
    chosen = next((k for k in range(top + 1) if sizes[k] <= SLICES), 0)
    leaves = nodes.where("level = 0").select(F.col("place").alias("run"), F.col("key").alias("leaf"), F.col("key").alias("up"), "parent")
    for k in range(1, chosen + 1):
        higher = nodes.where(F.col("level") == k).select(F.col("key").alias("up"), F.col("parent").alias("next"))
        leaves = leaves.select("run", "leaf", F.col("parent").alias("up")).join(higher, "up").withColumnRenamed("next", "parent")
    folders = nodes.where(F.col("level") == chosen).select(F.col("key").alias("up"), F.col("place").alias("slice"))
    entries = files.join(leaves.join(folders, "up").select("run", "leaf", "slice"), "run").select("path", "sha256", "leaf", "slice")
    return stored(entries, "tree-entries", "slice"), top, chosen


def tree_fingerprint(hashes: DataFrame, leaf: int = LEAF, fanout: int = FANOUT) -> DataFrame:
    """One row (files, fingerprint) for a set of files (path, sha256), whatever the order of its rows."""
    return build_tree(hashes, leaf, fanout).root()


def _unequal(one: DataFrame, other: DataFrame) -> DataFrame:
    """Nodes whose digest the other side lacks."""
    return one.join(other.select("digest").distinct(), "digest", "left_anti")


def _slices(tree: Tree, nodes: DataFrame) -> list[int]:
    """Folders of the entries below ``nodes`` of the level that has folders: at most about ``SLICES``."""
    return [r["place"] for r in nodes.select("place").collect()]


def unequal_leaves(before: Tree, after: Tree) -> tuple[tuple[DataFrame, list[int]], tuple[DataFrame, list[int]]]:
    """Of each tree the leaves that the other lacks, and the folders they lie in, found from the roots down: of each level
    only the children of unequal nodes are looked at."""
    trees = (before, after)
    at = lambda tree, level: tree.nodes.where(F.col("level") == level)
    level = min(t.top for t in trees)
    front = [at(t, level) for t in trees]
    slices: list[list[int] | None] = [_slices(t, at(t, t.level)) if t.level > level >= 0 else None for t in trees]
    while level >= 0:
        left = [stored(_unequal(front[i], front[1 - i]), "tree-unequal") for i in (0, 1)]
        slices = [_slices(t, left[i]) if t.level == level else s for i, (t, s) in enumerate(zip(trees, slices))]
        front = left
        level -= 1
        if level >= 0:
            front = [at(t, level).join(left[i].select(F.col("key").alias("parent")), "parent", "left_semi") for i, t in enumerate(trees)]
    return tuple((front[i], slices[i]) for i in (0, 1))


def tree_diff(before: Tree, after: Tree) -> DataFrame:
    """Files that differ: path, outcome (added, removed, changed), sha256_before, sha256_after. Equal subtrees are not read."""
    if min(before.top, after.top) < 0:
        sides = [t.entries for t in (before, after)]
    else:
        sides = []
        for tree, (leaves, slices) in zip((before, after), unequal_leaves(before, after)):
            known = tree.entries if slices is None else tree.entries.where(F.col("slice").isin(slices))
            sides.append(known.join(leaves.select(F.col("key").alias("leaf")), "leaf", "left_semi"))
    one, other = (s.select("path", F.col("sha256").alias(f"sha256_{n}")) for s, n in zip(sides, ("before", "after")))
    outcome = F.when(F.col("sha256_before").isNull(), "added").when(F.col("sha256_after").isNull(), "removed").otherwise("changed")
    both = one.join(other, "path", "full")
    return both.where(~F.col("sha256_before").eqNullSafe(F.col("sha256_after"))).select("path", outcome.alias("outcome"), "sha256_before", "sha256_after")


def write_tree(tree: Tree, path: str) -> None:
    """Keep a tree, to compare later ones with it."""
    tree.nodes.write.partitionBy("level").parquet(f"{path}/nodes")
    tree.entries.write.partitionBy("slice").parquet(f"{path}/entries")


def read_tree(spark: SparkSession, path: str) -> Tree:
    nodes = spark.read.schema("place LONG, key STRING, parent STRING, files LONG, digest STRING, level INT").parquet(f"{path}/nodes")
    entries = spark.read.schema("path STRING, sha256 STRING, leaf STRING, slice LONG").parquet(f"{path}/entries")
    sizes = {r["level"]: r["count"] for r in nodes.groupBy("level").count().collect()}
    return Tree(nodes, entries, max(sizes, default=-1), next((k for k in sorted(sizes) if sizes[k] <= SLICES), 0))
