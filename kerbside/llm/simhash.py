"""SimHash near-duplicates by a grid join over segment bit counts."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import saved
from kerbside.llm.components import connected_components, merged, spanning_links

BITS = 64
EVEN = 0x5555555555555555  # the lower bit of each two-bit segment
CELL_ROWS = 4096  # fingerprints one task compares with each other; larger cells go in blocks
RUN_PAIRS = 32  # cells up to this size are compared side by side
FLUSH_LINKS = 500_000


def fingerprints(
    docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fingerprint bigint)``: one row a document, over its whole text.

    A-Z is lowered, words are runs without ASCII white space, shingles are ``words`` joined words
    (all words if fewer). A bit is set if it is in over half of the shingles' XXH64 (seed 42).
    Null and empty texts have no shingle and fingerprint zero; a null id stays null.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("fingerprint", T.LongType()),
    ])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(
                (fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, len(batch)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fingerprint"]
            )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(compute, schema)


def fingerprint(text: str | None, words: int) -> int:
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    size = min(words, len(tokens))
    join = b" ".join([b"%b"] * size).__mod__
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    shingles = zip(*(tokens[k:] for k in range(size)))
    hashes = np.fromiter(map(digest, map(join, shingles)), np.uint64, len(tokens) - size + 1)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 65_536):
        part = hashes[start:start + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def segment_counts(value: Column) -> Column:
    """The embedding: each two-bit segment holds how many of its bits are set (0, 1, 2)."""
    low = value.bitwiseAND(F.lit(EVEN))
    high = F.shiftrightunsigned(value, 1).bitwiseAND(F.lit(EVEN))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def grids(distance: int, agree: int) -> list[int]:
    """Masks of the coordinates each grid looks at.

    The 32 counts are dealt into ``distance + agree`` groups. Within Manhattan distance
    ``distance`` at most that many groups differ, so some ``agree`` groups are equal: the pair
    meets in a cell of one of the grids, of which there is one for each choice of groups.
    """
    groups = [0] * (distance + agree)
    for segment in range(BITS // 2):
        groups[segment % len(groups)] |= 3 << (2 * segment)
    masks = [sum(chosen) for chosen in combinations(groups, agree)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def near_links(prints: DataFrame, distance: int = 4, agree: int = 3) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints (distinct longs) within ``distance`` bits.

    A pair within ``distance`` bits is within that Manhattan distance in its segment counts, and
    so shares a grid cell. Inside a cell pairs are first bounded by the Manhattan distance, then
    compared bit by bit. A task returns a spanning set of links, not all pairs. Cells with more
    than ``CELL_ROWS`` fingerprints are dealt out as pairs of blocks, so none is dropped.
    """
    place = segment_counts(F.col("fingerprint"))
    cells = prints.select(
        "fingerprint",
        F.explode(F.array(*[
            F.struct(F.lit(g).alias("grid"), place.bitwiseAND(F.lit(mask)).alias("cell"))
            for g, mask in enumerate(grids(distance, agree))
        ])).alias("at"),
    ).select("fingerprint", "at.grid", "at.cell")
    hot = saved(
        cells.groupBy("grid", "cell").count().where(F.col("count") > CELL_ROWS).select(
            "grid", "cell", F.ceil(F.col("count") / CELL_ROWS).cast("int").alias("blocks")
        ),
        "hot-cells",
    )
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    dealt = cells.join(hot, ["grid", "cell"], "left").select(
        "fingerprint", "grid", "cell",
        F.explode(
            F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"))))
            .otherwise(F.transform(
                F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1),
                lambda other: F.struct(
                    F.least(own, other).alias("x"), F.greatest(own, other).alias("y")
                ),
            ))
        ).alias("block"),
    ).select("grid", "cell", "block.x", "block.y", "fingerprint")
    key = ["grid", "cell", "x", "y"]
    compare = partial(_compare_cells, distance=distance)
    return (
        dealt.repartition(*key).sortWithinPartitions(*key)
        .mapInArrow(compare, "a bigint, b bigint")
    )


def _compare_cells(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = None
    for batch in batches:
        rows = [np.asarray(column) for column in batch.columns]
        if held is not None:
            rows = [np.concatenate(pair) for pair in zip(held, rows)]
        new = np.zeros(len(rows[0]), bool)
        for column in rows[:4]:
            new[1:] |= column[1:] != column[:-1]
        last = int(np.flatnonzero(new)[-1]) if new.any() else 0
        held = [column[last:] for column in rows]  # the last cell may go on in the next batch
        if last:
            found.append(_links_in_runs(rows[4][:last], new[:last], distance))
        if sum(len(a) for a, _ in found) > FLUSH_LINKS:
            found = [spanning_links(*map(np.concatenate, zip(*found)))]
            if len(found[0][0]) > FLUSH_LINKS:
                yield _link_batch(*found.pop())
    if held is not None and len(held[0]):
        found.append(_links_in_runs(held[4], np.zeros(len(held[4]), bool), distance))
    if found:
        yield _link_batch(*spanning_links(*map(np.concatenate, zip(*found))))


def _link_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _links_in_runs(prints, new, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of each run of equal cells; ``new`` marks where a run begins."""
    run = np.cumsum(new)
    size = np.bincount(run)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    a, b = [prints[:0]], [prints[:0]]
    small = np.repeat(size <= RUN_PAIRS, size)
    values, runs = prints[small], run[small]
    for step in range(1, RUN_PAIRS):
        together = np.flatnonzero(runs[step:] == runs[:-step])
        if not len(together):
            break
        x, y = values[together], values[together + step]
        close = _within(x, y, distance)
        a.append(x[close])
        b.append(y[close])
    for k in np.flatnonzero(size > RUN_PAIRS):
        x, y = _links_in_cell(prints[begin[k]:begin[k] + size[k]], distance)
        a.append(x)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def _links_in_cell(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    prints = np.unique(prints)
    label = np.arange(len(prints))
    for start in range(0, len(prints), 256):
        i, j = np.nonzero(_within(prints[start:start + 256, None], prints[None, :], distance))
        label = merged(label, i + start, j)
    moved = np.flatnonzero(label != np.arange(len(prints)))
    return prints[label[moved]], prints[moved]


def _within(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    """Manhattan distance of the segment counts first, a lower bound; then the differing bits."""
    x, y = x.view(np.uint64), y.view(np.uint64)
    even = np.uint64(EVEN)
    one = np.uint64(1)
    p, q = _segment_counts(x), _segment_counts(y)
    differ = p ^ q
    low, high = differ & even, (differ >> one) & even
    bound = np.bitwise_count(low) + 2 * np.bitwise_count(high & ~low)
    return (bound <= distance) & (np.bitwise_count(x ^ y) <= distance)


def _segment_counts(x: np.ndarray) -> np.ndarray:
    even, one = np.uint64(EVEN), np.uint64(1)
    low, high = x & even, (x >> one) & even
    return (low ^ high) | ((low & high) << one)


def near_duplicates(
    docs: DataFrame, words: int = 5, distance: int = 4,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, fingerprint bigint, component_id)``: one row for each row of ``docs``.

    ``component_id`` is the least id reachable over links; null ids are passed over, and a
    component of null ids only has a null one. Copies share a fingerprint and are folded before
    any comparison. Repeated rows stay repeated; other columns are not looked at; an empty table
    gives no rows.
    """
    prints = saved(fingerprints(docs, words, id_col, text_col), "fingerprints")
    classes = saved(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "classes"
    )
    roots = connected_components(near_links(classes.select("fingerprint"), distance))
    rooted = saved(
        classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")),
        "rooted",
    )
    least = saved(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    named = saved(
        rooted.join(least, "root").select("fingerprint", "component_id"), "components"
    )
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = 5, distance: int = 4) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one of least ``doc_id``.

    Rows without an id stay if their whole group has none. Rows that share an id are one document.
    """
    groups = near_duplicates(docs, words, distance)
    dropped = saved(
        groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("gone_id")).distinct(),
        "near-copies",
    )
    # Copies grow with the documents: the same join at every size, not a broadcast at first.
    return docs.hint("merge").join(dropped, docs["doc_id"].eqNullSafe(dropped["gone_id"]), "left_anti")
