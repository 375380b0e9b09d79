"""What each step of a filter chain removes, for every order of the filters, as contractions of a tensor.

Each document is a mask of the five filters it fails. Spark counts documents by (part, mask, labels), which
leaves at most 128 rows a part whatever its size, and turns them into one row per part: its counts as arrays
of 32. A task reshapes them to 2x2x2x2x2, one axis per filter (0 pass, 1 fail), and contracts every axis with a
selector: pass (1, 0), fail (0, 1) or all (1, 1). The documents that step 3 of the order BDACE removes, for
instance, pass B and D, fail A, and are anything else: pass, fail and all along the axes are the whole rule.

Defined results: a null text counts as empty, a null part as the empty string. A null id is smaller and larger
than none, so its row fails no comparison with other rows. A label row without an id is no one's; of several
label rows of an id any that says so counts. Rows that repeat an id are documents of their own. An empty table
has no part, hence no row. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import slices
from rankloom.llm.exact_dedup import UPPER, duplicate_groups
from rankloom.session import stored

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
CELLS = 1 << len(FILTERS)
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
#: Parts contracted at once: 600 steps of a part are some 50 KB of results.
PARTS_AT_ONCE = 64

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 2
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#$%&*|]"


def failures(text: Column, words: Column) -> list[Column]:
    """Filters A to D on a text: true where it fails. E needs the other texts."""
    upper = F.octet_length(text) - F.octet_length(F.translate(text, UPPER, ""))
    return [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)).cast("long") < MIN_DISTINCT_PERCENT * F.size(words).cast("long"),
        100 * upper.cast("long") > MAX_UPPER_PERCENT * F.char_length(text).cast("long"),
        text.rlike(SYMBOL),
    ]


def bit(k: int) -> int:
    """The bit of filter ``k`` in a mask, so that filter ``k`` is axis ``k`` of the reshaped counts."""
    return 1 << (len(FILTERS) - 1 - k)


def failure_masks(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``id``, ``part`` and ``mask``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", text.alias("text"), F.coalesce("source", F.lit("")).alias("part"), F.regexp_extract_all(text, F.lit(f"({WORD})"), 1).alias("words"))
    bits = [F.when(fails, bit(k)).otherwise(0) for k, fails in enumerate(failures(F.col("text"), F.col("words")))]
    masked = split.select("doc_id", "text", "part", sum(bits, F.lit(0)).alias("mask"))
    equal = duplicate_groups(masked, fold=False, carry=("part", "mask"))
    copy = F.when(F.col("id") > F.col("keep_id"), bit(4)).otherwise(0)
    return equal.select("id", "part", (F.col("mask") + copy).alias("mask"))


def label_flags(labels: DataFrame) -> DataFrame:
    """One row per labelled id: ``good`` and ``toxic``."""
    said = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    flags = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
    return flags.agg(said("quality").alias("good"), said("toxic").alias("toxic"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part: ``cells``, a list of at most 128 (mask, good, toxic, n)."""
    known = failure_masks(docs).join(stored(label_flags(labels), "filter-labels"), "id", "left")
    flag = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    counted = known.groupBy("part", "mask", flag("good"), flag("toxic")).agg(F.count("*").alias("n"))
    return counted.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))


def selectors(rule) -> np.ndarray:
    """(orders * steps, filters, 2): the selector of each axis, where ``rule(order, step, filter)`` names it."""
    steps = [[rule(order, s, f) for f in FILTERS] for order in ORDERS for s in range(len(FILTERS))]
    return np.array(steps, np.int64)


KEPT = selectors(lambda order, s, f: PASS if f in order[: s + 1] else ALL)
REMOVED = selectors(lambda order, s, f: PASS if f in order[:s] else FAIL if f == order[s] else ALL)
FAILED = selectors(lambda order, s, f: FAIL if f == order[s] else ALL)
ONLY = selectors(lambda order, s, f: FAIL if f == order[s] else PASS)
#: (filter of the step, as number) for each order and step, and its letter.
STEP_FILTER = np.array([FILTERS.index(f) for order in ORDERS for f in order])


def contract(counts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """(parts, 2, 2, 2, 2, 2) counts under each step's selectors: (parts, steps), exact in 64-bit integers."""
    axes = [chosen[:, k] for k in range(len(FILTERS))]
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", counts, *axes, optimize=True)


def step_figures(counts: np.ndarray) -> dict[str, np.ndarray]:
    """``counts``: (parts, 3, 32), all, good and toxic documents by mask. Each figure is (parts, orders * steps)."""
    every, good, toxic = (np.ascontiguousarray(counts[:, k]).reshape(-1, 2, 2, 2, 2, 2) for k in range(3))
    removed = contract(every, REMOVED)
    shares = np.stack([removed[:, STEP_FILTER == k].sum(axis=1) for k in range(len(FILTERS))], axis=1)
    return {
        "kept": contract(every, KEPT),
        "removed": removed,
        "redundant": contract(every, FAILED) - removed,
        "unique_fails": contract(every, ONLY),
        "good_lost": contract(good, REMOVED),
        "toxic_lost": contract(toxic, REMOVED),
        "shapley": shares[:, STEP_FILTER],
    }


FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
RESULT = "part string, filter_order string, step int, filter string, " + ", ".join(f"{c} long" for c in FIGURES)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    per_part = len(ORDERS) * len(FILTERS)
    orders = np.repeat(ORDERS, len(FILTERS))
    numbers = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
    letters = np.array(list("".join(ORDERS)))
    for batch in batches:
        names, cells = batch.column("part").to_pylist(), batch.column("cells").to_pylist()
        for a, z in slices([1] * len(names), PARTS_AT_ONCE):
            counts = np.zeros((z - a, 3, CELLS), np.int64)
            for p, listed in enumerate(cells[a:z]):
                for cell in listed:
                    counts[p, [True, cell["good"], cell["toxic"]], cell["mask"]] += cell["n"]
            figures = step_figures(counts)
            columns = {
                "part": pa.array([n for n in names[a:z] for _ in range(per_part)], pa.string()),
                "filter_order": pa.array(np.tile(orders, z - a), pa.string()),
                "step": pa.array(np.tile(numbers, z - a)),
                "filter": pa.array(np.tile(letters, z - a), pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns | {c: pa.array(figures[c].ravel()) for c in FIGURES})


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows per part: each order of the filters, each of its steps."""
    return mask_counts(docs, labels).mapInArrow(_steps, RESULT)
