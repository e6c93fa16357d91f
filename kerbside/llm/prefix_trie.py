"""The trie of conversations' beginnings: which turns are shared, by how many, and what that saves.

A turn is named by 128 bits of a SHA-256 of its role and text, and a conversation by its turns' names
in order. Equal conversations are folded, the rest is dealt into shards by ranges of that order. In
a shard, the turns make a padded matrix of ids; its rows are sorted with ``lexsort``, compared with the
row before column by column, and the OR-accumulated changes mark where nodes start at each depth,
so that ``reduceat`` gives each node's sums. Only the nodes above a shard's first and last rows can go
on in other shards. Those rows, two a shard, form a small trie of the same kind, in which the parts
of such nodes are added up.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import saved

NAME_BYTES = 16
SHARD_TURNS = 16_384  # turns of different conversations in a shard, on average
MAX_SHARDS = 20_000  # beyond, shards grow
DEPTH_BLOCK = 16  # columns of the padded matrix held at a time
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_name(role: Column, text: Column) -> Column:
    """Lower-case hex of 128 bits that tell turns apart."""
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(told.cast("binary"), 256), 1, 2 * NAME_BYTES)


def conversation_paths(turns: DataFrame) -> DataFrame:
    """``(conv_id, path)``: each conversation's turns in order, as ``(name, size)``.

    ``turns`` has ``(conv_id, turn, role, text)``. Null roles and texts are empty; a null turn comes
    first; turns of the same number follow each other by name, repeated ones stay. Rows without a
    conversation are none. ``size`` is the text's length in code points. A conversation is one row, in
    which a turn takes some 40 bytes however long its text.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    named = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct("turn", turn_name(role, text).alias("name"), F.length(text).alias("size")).alias("t"),
    )
    ordered = F.sort_array(F.collect_list("t"))
    return named.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["name"].alias("name"), t["size"].alias("size")))
        .alias("path")
    )


def with_shared_heads(paths: DataFrame, block: int, heads: int) -> DataFrame:
    """Conversations that begin as the first of their block does.

    The first ``h`` turns of conversation ``c`` become those of conversation ``c - c % block`` (all it
    has if fewer, none if there is no such conversation); ``h`` is crc32 of ``c`` as text, modulo
    ``heads``. Its own turns from the ``h``-th on follow.
    """
    conv = F.col("conv_id")
    first = paths.where(conv % block == 0).select(
        conv.alias("first_id"), F.slice("path", 1, heads).alias("head")
    )
    h = (F.crc32(conv.cast("string").cast("binary")) % heads).cast("int")
    begun = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), h)).otherwise(
        F.slice("path", 1, 0)
    )
    own = F.slice("path", h + 1, F.greatest(F.size("path") - h, F.lit(0)))
    joined = paths.join(first, conv - conv % block == F.col("first_id"), "left")
    return joined.select("conv_id", F.concat(begun, own).alias("path"))


def folded(paths: DataFrame) -> DataFrame:
    """``(seq, sizes, n, conv_id, ends)``: one row for each different path.

    ``seq`` is the turns' names, ``n`` the number of conversations, ``conv_id`` the smallest, and
    ``ends`` the SHA-256 of their ids in ascending order, joined by commas.

    Conversations are sorted by path and id over all tasks, so a path that a third of them take is
    split; each task writes runs of ids down as text. A hash goes over bytes in their order: what one
    task reads of a path is that text, as a stream.
    """
    seq = F.unhex(F.array_join(F.transform("path", lambda t: t["name"]), ""))
    rows = saved(paths.select(
        F.unhex(F.sha2(seq, 256)).alias("key"), "conv_id", seq.alias("seq"),
        F.transform("path", lambda t: t["size"].cast("bigint")).alias("sizes"),
    ), "paths")
    columns = "key binary, conv_id bigint, seq binary, sizes array<bigint>, n bigint, ids string"

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            starts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
            ends = [*starts[1:], len(keys)]
            yield pa.RecordBatch.from_arrays([
                *(c.take(pa.array(starts, pa.int64())) for c in batch.columns),
                pa.array([e - s for s, e in zip(starts, ends)], pa.int64()),
                pa.array([",".join(map(str, convs[s:e])) for s, e in zip(starts, ends)], pa.string()),
            ], names=["key", "conv_id", "seq", "sizes", "n", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, n, ends = None, None, 0, None

        def row() -> pa.RecordBatch:
            own = [first.column("seq"), first.column("sizes"), pa.array([n], pa.int64()),
                   first.column("conv_id"), pa.array([ends.hexdigest()])]
            return pa.RecordBatch.from_arrays(own, names=["seq", "sizes", "n", "conv_id", "ends"])

        for batch in batches:
            keys, counts, ids = (batch.column(c).to_pylist() for c in ("key", "n", "ids"))
            done = []
            for i, k in enumerate(keys):
                if k != key:
                    if key is not None:
                        done.append(row())
                    key, first, n, ends = k, batch.slice(i, 1), 0, hashlib.sha256()
                else:
                    ends.update(b",")
                n += counts[i]
                ends.update(ids[i].encode())
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if key is not None:
            yield row()

    sorted_rows = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    written = sorted_rows.mapInArrow(runs, columns)
    by_path = written.repartition("key").sortWithinPartitions("key", "conv_id")
    return by_path.mapInArrow(
        hashes, "seq binary, sizes array<bigint>, n bigint, conv_id bigint, ends string"
    )


class Rows(NamedTuple):
    """Paths in lexicographic order: for each the count of turns, and where its turns are in ``ids``."""

    ids: np.ndarray
    depths: np.ndarray
    starts: np.ndarray


def turn_ids(names: bytes) -> np.ndarray:
    """A number for each different name, from 1 on, in the order of the names."""
    high, low = np.frombuffer(names, ">u8").reshape(-1, 2).T.astype(np.uint64)
    order = np.lexsort((low, high))
    changed = np.ones(len(order), bool)
    changed[1:] = (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)
    ids = np.empty(len(order), np.int32)
    ids[order] = np.cumsum(changed)
    return ids


def _block(rows: Rows, which: np.ndarray, first: int) -> np.ndarray:
    """The padded matrix of some rows' turns from depth ``first`` on."""
    places = np.arange(first, first + DEPTH_BLOCK)
    there = places < rows.depths[which][:, None]
    at = np.where(there, rows.starts[which][:, None] + places, 0)
    return np.where(there, rows.ids[at] if len(rows.ids) else 0, 0).astype(np.int32)


def lexicographic(rows: Rows) -> np.ndarray:
    """The rows' order by their turns; sorted block by block, a row only as deep as it goes."""
    order = np.arange(len(rows.depths))
    rank = np.zeros(len(order), np.int64)  # of the order so far, equal for equal beginnings
    deepest = int(rows.depths.max(initial=0))
    for first in range(0, deepest, DEPTH_BLOCK):
        places = np.flatnonzero(rows.depths[order] >= first)
        which = order[places]
        block = _block(rows, which, first)
        by = np.lexsort((*block.T[::-1], rank[places]))
        order[places] = which[by]
        block, ranks = block[by], rank[places][by]
        changed = np.ones(len(by), bool)
        changed[1:] = (np.diff(ranks) != 0) | (np.diff(block, axis=0) != 0).any(axis=1)
        rank[places] = places[np.flatnonzero(changed)][np.cumsum(changed) - 1]
    return order


def levels(rows: Rows) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(depth, members, starts)`` for each depth from 1 on: the rows at least that deep, and which of
    them are the first of their node. ``rows`` must be in lexicographic order."""
    deepest = int(rows.depths.max(initial=0))
    differs = np.zeros(len(rows.depths), bool)  # from the row before, in the columns so far
    differs[:1] = True
    for first in range(0, deepest, DEPTH_BLOCK):
        members = np.flatnonzero(rows.depths > first)
        block = _block(rows, members, first)
        changed = np.ones(block.shape, bool)
        changed[1:] = np.diff(block, axis=0) != 0
        changed[1:][np.diff(members) > 1] = True  # the row before ends earlier
        changed[:, 0] |= differs[members]
        marks = np.logical_or.accumulate(changed, axis=1)
        for k in range(min(DEPTH_BLOCK, deepest - first)):
            deep = block[:, k] != 0
            yield first + k + 1, members[deep], np.flatnonzero(marks[deep, k])
        differs[members] = marks[:, -1]


class Trie(NamedTuple):
    """Nodes by depth, the root first; ``above`` is a node's parent, ``place`` its first row."""

    depth: np.ndarray
    above: np.ndarray
    place: np.ndarray
    until: np.ndarray
    sums: dict[str, np.ndarray]
    end_of: np.ndarray  # the node at which each row ends


def trie(rows: Rows, add: dict[str, np.ndarray], least: np.ndarray, by_depth: bool) -> Trie:
    """Nodes with the sums of ``add`` and the least of ``least`` over their rows.

    The values are one a row, or with ``by_depth`` one a row and depth, the root's first.
    """
    n = len(rows.depths)
    node_of = np.zeros(n, np.int64)
    # Where a row's value for the root is.
    base = rows.starts + np.arange(n) if by_depth else np.arange(n)
    parts = [(np.zeros(1, np.int64),) * 3 + (np.array([n]),)]
    values = {k: [np.array([v[base].sum()])] for k, v in add.items()}
    values["least"] = [np.array([least[base].min()])]
    count = 1
    for depth, members, starts in levels(rows):
        at = base[members] + (depth if by_depth else 0)
        place = members[starts]
        sizes = np.diff(np.append(starts, len(members)))
        parts.append((np.full(len(starts), depth), node_of[place], place, place + sizes))
        for k, v in add.items():
            values[k].append(np.add.reduceat(v[at], starts))
        values["least"].append(np.minimum.reduceat(least[at], starts))
        node_of[members] = np.repeat(count + np.arange(len(starts)), sizes)
        count += len(starts)
    joined = [np.concatenate(x) for x in zip(*parts)]
    return Trie(*joined, {k: np.concatenate(v) for k, v in values.items()}, node_of)


def upward(depth: np.ndarray, above: np.ndarray, values: np.ndarray, which: np.ndarray) -> None:
    """Add the nodes' values to their parents', from the deepest on; only of nodes in ``which``."""
    ends = np.searchsorted(depth, np.arange(depth[-1] + 2))
    for d in range(int(depth[-1]), 0, -1):
        own = np.arange(ends[d], ends[d + 1])
        own = own[which[own]]
        np.add.at(values, above[own], values[own])


NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
# What a shard's first (side 0) and last row (side 1) know of the nodes above them, the root's first.
EDGE = (
    "shard int, side int, seq binary, sizes array<bigint>, edge_n array<bigint>, "
    "edge_conv array<bigint>, edge_children array<bigint>, edge_leaves array<bigint>, "
    "edge_saved array<bigint>, edge_ends array<string>"
)
_LISTS = ("n", "conv", "children", "leaves", "saved")


def _rows(seqs: pa.Array) -> Rows:
    lists = seqs.to_pylist()
    depths = np.array([len(s) // NAME_BYTES for s in lists], np.int64)
    starts = np.cumsum(depths) - depths
    return Rows(turn_ids(b"".join(lists)), depths, starts)


def shard_nodes(table: pa.Table, shard: int) -> Iterator[pa.Table]:
    """A shard's inner nodes, complete but for parents that lie on its edges; then its two edges."""
    rows = _rows(table["seq"])
    order = lexicographic(rows)
    rows = Rows(rows.ids, rows.depths[order], rows.starts[order])
    table = table.take(pa.array(order))
    sizes = table["sizes"].combine_chunks().flatten().to_numpy()
    # Turns are numbered anew, in the rows' order.
    place_in = np.cumsum(rows.depths) - rows.depths
    n = table["n"].to_numpy()
    found = trie(rows, {"n": n}, table["conv_id"].to_numpy(), by_depth=False)
    count, last = len(found.depth), len(rows.depths) - 1
    size = np.where(found.depth > 0, sizes[
        np.where(found.depth > 0, place_in[found.place] + found.depth - 1, 0)
    ] if len(sizes) else 0, 0)
    edge = (found.place == 0) | (found.until == last + 1)
    inner = ~edge
    conv, convs = found.sums["least"], found.sums["n"]
    has_parent = found.depth > 0
    children = np.bincount(found.above[inner & has_parent], minlength=count)
    # A leaf has no child at all, an edge's child included.
    leaf = np.bincount(found.above[has_parent], minlength=count) == 0
    leaves = (leaf & inner).astype(np.int64)
    saved_tokens = np.where(inner, (convs - 1) * size, 0)
    upward(found.depth, found.above, leaves, inner)
    upward(found.depth, found.above, saved_tokens, inner)
    ends = np.full(count, None, object)
    ends[found.end_of] = table["ends"].to_numpy(zero_copy_only=False)
    own = np.flatnonzero(inner)
    above = found.above[own]
    on_edge = edge[above]
    yield pa.table({
        "conv_id": conv[own], "depth": found.depth[own],
        "parent_conv_id": pa.array(conv[above], mask=on_edge),
        "n_convs": convs[own], "n_children": children[own], "n_leaves": leaves[own],
        "saved_tokens": saved_tokens[own],
        "ends_sha256": pa.array([x or NO_ENDS for x in ends[own]], pa.string()),
        "shard": pa.array(np.full(len(own), shard), pa.int32()),
        # The edge on which the parent lies.
        "parent_side": pa.array((found.place[above] != 0).astype(np.int32), mask=~on_edge),
    })
    values = dict(zip(_LISTS, (convs, conv, children, leaves, saved_tokens)))
    for side, row in enumerate((0, last)):
        path = np.flatnonzero((found.place <= row) & (row < found.until))
        # What both edges share is told by the first one; the last one's values there add nothing.
        told = np.ones(len(path), bool) if side == 0 else found.place[path] != 0
        lists = {
            f"edge_{k}": pa.array([np.where(told, v[path], conv[path] if k == "conv" else 0)])
            for k, v in values.items()
        }
        yield pa.table({
            "shard": pa.array([shard], pa.int32()), "side": pa.array([side], pa.int32()),
            "seq": table["seq"].slice(row, 1), "sizes": table["sizes"].slice(row, 1), **lists,
            "edge_ends": pa.array([[x if t else None for x, t in zip(ends[path], told)]],
                                  pa.list_(pa.string())),
        })


def join_edges(edges: pa.Table) -> Iterator[pa.Table]:
    """The nodes on all shards' edges, whole; then each edge's nodes' ids by depth.

    ``edges`` are in the order of shards and sides, which is that of their paths.
    """
    rows = _rows(edges["seq"])
    flat = {k: edges[f"edge_{k}"].combine_chunks().flatten().to_numpy() for k in _LISTS}
    texts = np.array(edges["edge_ends"].combine_chunks().flatten().to_pylist(), object)
    sizes = edges["sizes"].combine_chunks().flatten().to_numpy()
    found = trie(rows, {k: flat[k] for k in _LISTS if k != "conv"}, flat["conv"], by_depth=True)
    has_parent = found.depth > 0
    conv, convs = found.sums["least"], found.sums["n"]
    size = np.zeros(len(conv), np.int64)
    size[has_parent] = sizes[(rows.starts[found.place] + found.depth - 1)[has_parent]]
    children = found.sums["children"] + np.bincount(found.above[has_parent], minlength=len(conv))
    leaves = found.sums["leaves"] + (children == 0)
    saved_tokens = found.sums["saved"] + (convs - 1) * size
    every = np.ones(len(conv), bool)
    upward(found.depth, found.above, leaves, every)
    upward(found.depth, found.above, saved_tokens, every)
    # A path's nodes, from its last one up.
    ends = np.full(len(conv), None, object)
    base = rows.starts + np.arange(len(rows.depths))
    shards, sides = (edges[c].to_pylist() for c in ("shard", "side"))
    listed = []
    for row, node in enumerate(found.end_of.tolist()):
        path = []
        for depth in range(int(rows.depths[row]), -1, -1):
            path.append(conv[node])
            ends[node] = ends[node] or texts[base[row] + depth]
            node = found.above[node]
        listed.append(path[::-1])
    yield pa.table({
        "conv_id": conv, "depth": found.depth,
        "parent_conv_id": pa.array(conv[found.above], mask=~has_parent),
        "n_convs": convs, "n_children": children, "n_leaves": leaves, "saved_tokens": saved_tokens,
        "ends_sha256": pa.array([x or NO_ENDS for x in ends], pa.string()),
    })
    yield pa.table({
        "shard": pa.array(shards, pa.int32()), "side": pa.array(sides, pa.int32()),
        "edge_conv": pa.array(listed, pa.list_(pa.int64())),
    })


_ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
}


def _over_partition(make, fields: str):
    """A function for ``mapInArrow`` that takes a task's rows whole; columns not given are null."""
    kinds = {name: _ARROW[kind] for name, kind in (f.split() for f in fields.split(","))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [b for b in batches if len(b)]
        if not given:
            return
        for part in make(pa.Table.from_batches(given)):
            arrays = [
                part[name].cast(kind) if name in part.column_names else pa.nulls(len(part), kind)
                for name, kind in kinds.items()
            ]
            yield from pa.table(arrays, names=list(kinds)).combine_chunks().to_batches(10_000)

    return run


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row a node: each different beginning of the conversations in ``(conv_id, path)``.

    ``conv_id`` is the smallest conversation that begins so, ``parent_conv_id`` its parent's (null for
    the root, the empty beginning), ``n_convs`` their number, ``n_children`` and ``n_leaves`` count
    children and childless nodes of the subtree, itself included; ``saved_tokens`` sums over the
    subtree what storing a node once saves: its last text's code points for each conversation but one.
    ``ends_sha256`` is the hash of the ids of conversations that end here. A conversation without turns
    belongs to the root; without any conversation there are no nodes.
    """
    different = saved(folded(paths), "folded")
    turns = different.agg(F.sum(F.length("seq"))).first()[0]
    shards = min(MAX_SHARDS, max(1, math.ceil((turns or 0) / NAME_BYTES / SHARD_TURNS)))
    fields = f"{NODE}, {EDGE}, parent_side int"
    ranged = different.repartitionByRange(shards, "seq")
    parts = saved(ranged.mapInArrow(
        _over_partition(lambda t: shard_nodes(t, TaskContext.get().partitionId()), fields), fields
    ), "shards")
    nodes = [f.split()[0] for f in NODE.split(",")]
    edges = parts.where(F.col("side").isNotNull()).select(*[f.split()[0] for f in EDGE.split(",")])
    edge_fields = f"{NODE}, shard int, side int, edge_conv array<bigint>"
    joined = saved(
        edges.repartition(1).sortWithinPartitions("shard", "side")
        .mapInArrow(_over_partition(join_edges, edge_fields), edge_fields), "edges",
    )
    inner = parts.where(F.col("side").isNull())
    below_edge = inner.where(F.col("parent_side").isNotNull()).drop("side", "edge_conv", "parent_conv_id")
    known = joined.where(F.col("side").isNotNull()).select(
        "shard", F.col("side").alias("parent_side"), F.posexplode("edge_conv").alias("at", "parent_conv_id")
    ).withColumn("depth", F.col("at") + F.lit(1).cast("bigint"))
    return (
        joined.where(F.col("side").isNull()).select(*nodes)
        .unionAll(inner.where(F.col("parent_side").isNull()).select(*nodes))
        .unionAll(below_edge.join(known, ["shard", "parent_side", "depth"]).select(*nodes))
    )
