"""Connected components of a graph given by its links, by repeated contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.plans.storage import written


def united(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links, and of each the least node that a path joins it to."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    return nodes, nodes[root]


def _in_one_task(links: DataFrame) -> DataFrame:
    """``(node, to)`` for every node of a few links: what it points to is its root."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if some := list(it):
            found = pa.Table.from_batches(some)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in united(found["a"].to_numpy(), found["b"].to_numpy())], names=["node", "to"])

    return links.repartition(1).mapInArrow(run, "node bigint, to bigint")


def components(links: DataFrame, local: int = 0) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``: nodes are joined by a path exactly if their roots are equal.

    Each round, every node points to the least of itself and its neighbours (by a hash, so that long chains shrink by a
    constant share too), links are moved to what their ends point to, and loops and repeats go. The pointers of all rounds
    are followed in the end. Links only shrink; each round's tables are written to the shared folder. Null ends are left
    out; no links give no rows. Nothing but row counts comes to the driver.

    As soon as ``local`` links or fewer are left, one task does the rest: each round costs the driver a dozen jobs, however
    few its links are. This takes nodes that are bigint, and links that are cheap to read twice.
    """
    order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    left = links.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    if local and left.count() <= local:
        return written(_in_one_task(left).withColumnRenamed("to", "root"), "roots")
    left = written(left.distinct(), "links")
    pointers = []
    while not left.isEmpty():
        if local and left.count() <= local:
            pointers.append(written(_in_one_task(left), "pointers"))
            break
        both = left.select(F.col("a").alias("node"), order("b").alias("to")).union(left.select(F.col("b").alias("node"), order("a").alias("to")))
        least = both.groupBy("node").agg(F.min("to").alias("to"))
        to = written(least.select("node", F.least(F.col("to"), order("node")).getField("id").alias("to")), "pointers")
        pointers.append(to)
        moved = left.join(to.select(F.col("node").alias("a"), F.col("to").alias("a_to")), "a").join(to.select(F.col("node").alias("b"), F.col("to").alias("b_to")), "b")
        moved = moved.where(F.col("a_to") != F.col("b_to")).select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct()
        left = written(moved, "links")
    if not pointers:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # from the last round back: what a node points to has its root among the later rounds' nodes, or is a root
    roots = pointers[-1].select("node", F.col("to").alias("root"))
    for i, to in enumerate(reversed(pointers[:-1])):
        later = roots.select(F.col("node").alias("to"), "root")
        roots = to.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
        if i % 3 == 2:
            roots = written(roots, "roots")
    return written(roots, "roots")
