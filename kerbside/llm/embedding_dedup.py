"""Embedding near-duplicates by a forest of random-projection trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import saved
from kerbside.llm.components import connected_components, merged

TREES = 5
# Points within this much of a split go to both sides, in units of a unit vector's mean projection
# (1 / sqrt(dimensions)). Two unit vectors of cosine 0.9 differ by about 0.45 such units.
SPILL = 0.15
# The trees are fitted on at most about this many vectors; every vector goes down every tree.
SAMPLE_VECTORS = 50_000
LEAF_ROWS = 500
LEAST_SAMPLE = 16  # a node with fewer sampled vectors is not split
BLOCK_ROWS = 2_048  # larger leaves are compared as pairs of blocks of about this size
SEED = 20_240_101


@dataclass
class Tree:
    """Nodes by number: direction, threshold, children; a leaf has its number in the forest."""

    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    leaves: np.ndarray

    def leaf_pairs(self, unit: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """``(row, leaf)`` of each leaf that each row of ``unit`` reaches."""
        rows, leaves = [], []
        waiting = [(0, np.arange(len(unit)))]
        while waiting:
            node, own = waiting.pop()
            if self.leaves[node] >= 0 or not len(own):
                rows.append(own)
                leaves.append(np.full(len(own), max(self.leaves[node], 0)))
                continue
            place = unit[own] @ self.directions[node] - self.thresholds[node]
            left, right = self.children[node]
            waiting += [(left, own[place <= margin]), (right, own[place >= -margin])]
        return np.concatenate(rows), np.concatenate(leaves)


def fit_forest(sample: np.ndarray, leaf: int, trees: int = TREES) -> list[Tree]:
    """Split at the median of random projections until ``leaf`` sampled vectors or fewer are left.

    A node that the spill keeps together (its vectors lie within the margin) stays a leaf.
    """
    forest, n_leaves = [], 0
    margin = SPILL / np.sqrt(sample.shape[1])
    for number in range(trees):
        random = np.random.default_rng(SEED + number)
        directions, thresholds, children, leaves = [], [], [], []

        def grow(own: np.ndarray) -> int:
            nonlocal n_leaves
            node = len(leaves)
            direction = random.standard_normal(sample.shape[1])
            direction /= np.linalg.norm(direction)
            place = sample[own] @ direction
            middle = float(np.median(place)) if len(own) else 0.0
            left, right = own[place <= middle + margin], own[place >= middle - margin]
            directions.append(direction)
            thresholds.append(middle)
            children.append((-1, -1))
            leaves.append(-1)
            if len(own) <= leaf or max(len(left), len(right)) > 0.85 * len(own):
                leaves[node] = n_leaves
                n_leaves += 1
            else:
                children[node] = (grow(left), grow(right))
            return node

        grow(np.arange(len(sample)))
        forest.append(Tree(
            np.array(directions), np.array(thresholds), np.array(children), np.array(leaves)
        ))
    return forest


def vector_classes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(uid, values, weight, first_id)``: each distinct vector that can link, as 64-bit floats."""
    number = F.col(vector_col).cast("array<double>")
    fit = (
        F.col(vector_col).isNotNull()
        & ~F.exists(number, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(number, lambda x: x != 0)
    )
    classes = (
        vectors.where(fit).groupBy(number.alias("values"))
        .agg(F.count("*").alias("weight"), F.min(id_col).alias("first_id"))
        .withColumn("uid", F.monotonically_increasing_id())
    )
    return saved(classes, "vector-classes")


def leaf_rows(classes: DataFrame) -> DataFrame:
    """``(leaf, uid, weight, values, members)``: each vector once for each leaf it reaches.

    ``members`` lists all its leaves. Vectors of another length than the forest's have leaves of
    their own, one for each length.
    """
    sizes = {r[0]: r[1] for r in classes.groupBy(F.size("values")).count().collect()}
    forests = {}
    first_leaf = 0
    for size, n in sorted(sizes.items()):
        share = min(1.0, SAMPLE_VECTORS / n)
        place = F.xxhash64(F.lit(3), "values").bitwiseAND(F.lit((1 << 63) - 1))
        rows = classes.where(F.size("values") == size)
        if share < 1:
            rows = rows.where(place < F.lit(int(share * (2**63 - 2**10))))
        sample = _units(np.array(
            rows.select("values").orderBy(place).limit(2 * SAMPLE_VECTORS).toArrow()["values"].to_pylist(), float
        ).reshape(-1, size))
        leaf = max(LEAST_SAMPLE, round(LEAF_ROWS * share))
        forests[size] = (first_leaf, fit_forest(sample, leaf))
        first_leaf += sum(int((t.leaves >= 0).sum()) for t in forests[size][1])
    shared = classes.sparkSession.sparkContext.broadcast(forests)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2)
            lengths = np.asarray(values.value_lengths())
            members = [[] for _ in range(len(batch))]
            for size in np.unique(lengths):
                own = np.flatnonzero(lengths == size)
                unit = _units(_matrix(values.take(pa.array(own))))
                first, forest = shared.value[int(size)]
                for tree in forest:
                    for row, leaf in zip(*tree.leaf_pairs(unit, SPILL / np.sqrt(size))):
                        members[own[row]].append(int(leaf) + first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), values,
                 pa.array([sorted(m) for m in members], pa.list_(pa.int32()))],
                names=["uid", "weight", "values", "members"],
            )

    routed = classes.select("uid", "weight", "values").mapInArrow(
        route, "uid bigint, weight bigint, values array<double>, members array<int>"
    )
    return saved(routed, "leaf-members").withColumn("leaf", F.explode("members"))


def _matrix(values: pa.ListArray) -> np.ndarray:
    return np.asarray(values.flatten(), float).reshape(len(values), -1)


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows over a power of two, which rounds nothing, so that squares neither vanish nor overflow."""
    return rows / 2.0 ** np.floor(np.log2(np.abs(rows).max(axis=1, keepdims=True, initial=0)))


def _units(rows: np.ndarray) -> np.ndarray:
    rows = _scaled(rows)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def leaf_links(rows: DataFrame, cosine: float) -> DataFrame:
    """``(uid, links, root)``: in each leaf, how many vectors each is linked to, and its group.

    A pair counts in the first leaf that both reach. Leaves larger than ``BLOCK_ROWS`` are dealt
    out as pairs of blocks, so all pairs of a leaf are compared and no task holds a large leaf. No
    pair leaves a task: only sums, and one link for each vector to its group's least.
    """
    large = saved(
        rows.groupBy("leaf").count().where(F.col("count") > BLOCK_ROWS)
        .select("leaf", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks")),
        "large-leaves",
    )
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("uid"), blocks).cast("int")
    dealt = rows.join(large, "leaf", "left").select(
        "leaf", "uid", "weight", "values", "members", own.alias("own"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    ).select(
        "leaf", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        "own", "uid", "weight", "values", "members",
    )

    def compare(group: pa.Table) -> pa.Table:
        leaf, x, y = (group[c][0].as_py() for c in ("leaf", "x", "y"))
        uid, weight, block = (np.asarray(group[c]) for c in ("uid", "weight", "own"))
        values = _scaled(_matrix(group["values"].combine_chunks()))
        norms = np.linalg.norm(values, axis=1)
        earlier = _earlier_leaves(group["members"].combine_chunks(), leaf)
        links = np.zeros(len(uid), np.int64)
        label = np.arange(len(uid))
        for start in range(0, len(uid), 512):
            part = slice(start, start + 512)
            close = values[part] @ values.T >= cosine * norms[part, None] * norms[None, :]
            close &= earlier[part] @ earlier.T == 0
            if x == y:
                close &= uid[part, None] != uid[None, :]
            else:
                close &= block[part, None] != block[None, :]
            links[part] += close @ weight
            i, j = np.nonzero(close)
            label = merged(label, i + start, j)
        found = np.flatnonzero(links)
        return pa.table({
            "uid": pa.array(uid[found]), "links": pa.array(links[found]),
            "root": pa.array(uid[label[found]]),
        })

    return dealt.groupBy("leaf", "x", "y").applyInArrow(
        compare, "uid bigint, links bigint, root bigint"
    )


def _earlier_leaves(members: pa.ListArray, leaf: int) -> np.ndarray:
    """One column for each leaf before ``leaf`` that a row here also reaches."""
    flat = np.asarray(members.flatten())
    row = np.repeat(np.arange(len(members)), np.asarray(members.value_lengths()))
    before = flat < leaf
    names, column = np.unique(flat[before], return_inverse=True)
    table = np.zeros((len(members), len(names)), np.float32)
    table[row[before], column] = 1
    return table


def near_vectors(
    vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``: one row for each row of ``vectors``.

    ``n_links`` counts the other vectors linked directly, ``component_id`` is the least id reachable
    by links (null ids are passed over), ``kept`` marks the row of that id. Equal vectors link and
    are folded before the search. Vectors that are null, empty or zero, or hold a null or a
    non-finite number, link with nothing, and neither do vectors of different lengths. Found links
    are exact (cosine in double precision); the search may miss some. Repeated rows stay repeated
    and link with each other; an empty table gives no rows; other columns are not looked at.
    """
    classes = vector_classes(vectors, id_col, vector_col)
    found = saved(leaf_links(leaf_rows(classes), cosine), "leaf-links")
    roots = connected_components(found.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("uid").agg(F.sum("links").alias("links"))
    linked = saved(
        classes.join(counted, "uid", "left")
        .join(roots.withColumnRenamed("node", "uid"), "uid", "left")
        .select(
            "values", "first_id", F.coalesce("root", "uid").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        ),
        "linked-vectors",
    )
    least = saved(linked.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    named = saved(
        linked.join(least, "root").select("values", "n_links", "component_id"), "named-vectors"
    )
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("values")
    )
    component = F.coalesce("component_id", "vec_id")
    return rows.join(named, "values", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
