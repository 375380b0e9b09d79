"""Connected components of an edge table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import bucket_of, parts
from rankloom.session import stored

#: Edges that one task joins up by itself.
CHUNK = 500_000


def local_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges, and the least node of each one's component."""
    nodes, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = number[: len(a)], number[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, before[x], low)
        np.minimum.at(label, before[y], low)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[x] != label[y]
        x, y = x[open_], y[open_]
    return nodes, nodes[label]


def _joined_up(table: pa.Table) -> pa.Table:
    nodes, labels = local_labels(table.column("x").to_numpy(), table.column("y").to_numpy())
    return pa.table({"node": pa.array(nodes, pa.int64()), "label": pa.array(labels, pa.int64())})


def components(edges: DataFrame, a: str = "a", b: str = "b", chunk: int = CHUNK) -> DataFrame:
    """(node, label) for every node of an edge; label is the least node of its component. Nodes are longs.

    The edges are dealt to tasks of about ``chunk``; each joins up its own and gives every node one edge, to the
    least node it knows. If there is more than one task, rounds follow on these edges: a node takes the least label
    among itself and its neighbours, then the label of that label, so long paths shrink by half or more. Labels are
    combined before they are shuffled, so a node with very many edges is one row per task. Each round's
    table is written to the shared folder."""
    pairs = stored(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x != y").distinct(), "edges")
    n = parts(pairs.count(), chunk)
    dealt = pairs.withColumn("part", bucket_of(1, n, "x", "y"))
    labels = stored(dealt.groupBy("part").applyInArrow(_joined_up, "node long, label long"), "labels")
    if n == 1:
        return labels
    ends = labels.select(F.col("node").alias("x"), F.col("label").alias("y")).where("x != y").distinct()
    both = stored(ends.unionAll(ends.select("y", "x")), "edges")
    labels = stored(labels.groupBy("node").agg(F.min("label").alias("label")), "labels")
    while True:
        offered = both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("label").alias("offer"))
        least = labels.join(offered, labels["node"] == offered["x"], "left")
        least = least.select("node", F.col("label").alias("old"), F.least("label", F.coalesce("offer", "label")).alias("label"))
        up = labels.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
        jumped = least.join(up, least["label"] == up["n2"], "left").select("node", "old", F.least("label", F.coalesce("l2", "label")).alias("label"))
        now = stored(jumped, "labels")
        if now.where("old != label").limit(1).count() == 0:
            return now.select("node", "label")
        labels = now.select("node", "label")
