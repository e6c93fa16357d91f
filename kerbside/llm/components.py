"""Connected components of a link table, without gathering a component anywhere."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import saved


def connected_components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links between longs to ``(node, root)``: one root for each component.

    Contraction rounds: every node merges into the neighbour (or itself) of least hash, with a new
    hash each round, so that the number of nodes falls by a constant factor whatever the shape.
    Each round is two joins on a node, whose hot keys Spark can split, and aggregates that are
    partly done before the shuffle. Nodes without a link to another node do not appear.
    Nulls link nothing; repeated links count once; no links give no rows.
    """
    links = saved(
        links.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        ).distinct(),
        "links",
    )
    merges = []
    while not links.isEmpty():
        rank = lambda c: F.xxhash64(F.lit(len(merges)), c)
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(
            F.min_by("b", rank(F.col("b"))).alias("b"), F.min(rank(F.col("b"))).alias("least")
        )
        merge = saved(
            best.select(
                F.col("a").alias("node"),
                F.when(F.col("least") < rank(F.col("a")), F.col("b"))
                .otherwise(F.col("a")).alias("root"),
            ),
            "merge",
        )
        merges.append(merge)
        left = links.join(
            merge.select(F.col("node").alias("a"), F.col("root").alias("new_a")), "a"
        ).select("new_a", "b")
        ends = left.join(
            merge.select(F.col("node").alias("b"), F.col("root").alias("new_b")), "b"
        ).where("new_a <> new_b")
        links = saved(
            ends.select(
                F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")
            ).distinct(),
            "links",
        )
    if not merges:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = merges.pop()
    while merges:
        later = roots.select(F.col("node").alias("root"), F.col("root").alias("last"))
        roots = saved(
            merges.pop().join(later, "root", "left")
            .select("node", F.coalesce("last", "root").alias("root")),
            "roots",
        )
    return roots


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes with at most one link a node: each to its group's least."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = merged(np.arange(len(nodes)), place[: len(a)], place[len(a):])
    own = np.arange(len(nodes))
    moved = label != own
    return nodes[label[moved]], nodes[own[moved]]


def merged(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union the groups of positions ``i`` and ``j``; ``label`` points to a group's least."""
    while True:
        x, y = label[i], label[j]
        apart = x != y
        if not apart.any():
            return label
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            next_label = label[label]
            if np.array_equal(next_label, label):
                break
            label = next_label
