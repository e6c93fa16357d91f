"""Cost-balanced packing of token ids into sequences of bounded length."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.tokens import LowerWords, encoder

CAPACITY = 2048
GROUP_CHARS = 4_000_000  # text one task packs: about a million ids
# Cost of a piece of n ids: LINEAR * n + QUADRATIC * n * n, the layers' and the attention's share.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
ID_BYTES = 4


def token_pieces(
    docs: DataFrame, vocabulary: str, end_id: int, groups: int, capacity: int
) -> DataFrame:
    """``(doc_id, start, doc_tokens, ids, pack)``: each document's ids, cut after ``capacity`` each.

    ``ids`` are unsigned little-endian 32-bit integers. ``pack`` deals the pieces out evenly.
    """
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("start", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("pack", T.IntegerType()),
    ])
    end = end_id.to_bytes(ID_BYTES, "little")
    step = capacity * ID_BYTES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(LowerWords, vocabulary).encode
        turn = TaskContext.get().partitionId() * 7919
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                doc, start, total, ids = [], [], [], []
                for k, text in enumerate(batch.column(1)):
                    own = encode(text.as_py() or "") + end
                    for s in range(0, len(own), step):
                        doc.append(k)
                        start.append(s // ID_BYTES)
                        total.append(len(own) // ID_BYTES)
                        ids.append(own[s:s + step])
                pack = (np.arange(turn, turn + len(doc)) % groups).astype(np.int32)
                turn += len(doc)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(start, pa.int64()),
                     pa.array(total, pa.int64()), pa.array(ids, pa.binary()), pa.array(pack)],
                    names=schema.names,
                )

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = CAPACITY
) -> DataFrame:
    """``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``: one row a piece.

    Every id of every document, and ``end_id`` after it, lies in exactly one piece; ``start`` is
    its place in the document, ``offset`` in the sequence, where pieces follow without a gap. A null
    or empty text is its end id alone. Repeated rows are packed each on its own, null ids as well.
    An empty table gives no rows. ``capacity`` is a power of two.

    Pieces are dealt into groups whose number grows with the text, and each group is one task's
    bounded work. A group's sequences hold exactly its ids: all of ``capacity``, the last ones of
    smaller powers of two, so that nothing is padded.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, math.ceil(chars / GROUP_CHARS))
    pieces = token_pieces(docs, vocabulary, end_id, groups, capacity)
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ])

    def pack(group: pa.Table) -> pa.Table:
        ids = group["ids"].to_pylist()
        lengths = [len(x) // ID_BYTES for x in ids]
        first = group["pack"][0].as_py() << 32
        rows = list(assign(lengths, capacity))
        piece, begin, length, sequence, offset = (np.array(c, np.int64) for c in zip(*rows))
        taken = group.take(pa.array(piece))
        return pa.table({
            "doc_id": taken["doc_id"],
            "start": pa.array(np.asarray(taken["start"]) + begin),
            "length": pa.array(length),
            "ids": pa.array([
                ids[p][b * ID_BYTES:(b + n) * ID_BYTES] for p, b, n in zip(piece, begin, length)
            ], pa.binary()),
            "doc_tokens": taken["doc_tokens"],
            "sequence_id": pa.array(first + sequence),
            "offset": pa.array(offset),
        }, schema=pa.schema([
            ("doc_id", taken["doc_id"].type), ("start", pa.int64()), ("length", pa.int64()),
            ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
        ]))

    return pieces.groupBy("pack").applyInArrow(pack, schema)


def assign(lengths: list[int], capacity: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``(piece, begin, length, sequence, offset)`` for each part of each piece.

    The longest piece goes first, to the sequence of least cost that has room for it whole. If none
    has, it is cut: the sequence of least cost takes what it has room for, and the rest waits for
    its turn by length.
    """
    total = sum(lengths)
    sizes = [capacity] * (total // capacity)
    sizes += [1 << bit for bit in range(capacity.bit_length() - 1, -1, -1) if total % capacity >> bit & 1]
    used = [0] * len(sizes)
    cost = [0.0] * len(sizes)
    rooms = _Rooms(capacity)
    for sequence, size in enumerate(sizes):
        rooms.add(size, 0.0, sequence)
    waiting = [(-n, k, 0) for k, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    while waiting:
        n, piece, begin = heapq.heappop(waiting)
        n = -n
        room, sequence = rooms.cheapest(n) or rooms.cheapest(1)
        rooms.remove(room)
        part = min(n, room)
        yield piece, begin, part, sequence, used[sequence]
        used[sequence] += part
        cost[sequence] += LINEAR * part + QUADRATIC * part * part
        if room > part:
            rooms.add(room - part, cost[sequence], sequence)
        if n > part:
            heapq.heappush(waiting, (part - n, piece, begin + part))


class _Rooms:
    """Sequences by the room they have left; finds the cheapest with at least some room."""

    NONE = (math.inf, -1)

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(self.size)]
        self.tree = [(self.NONE, 0)] * (2 * self.size)  # the cheapest below a node, and its room

    def add(self, room: int, cost: float, sequence: int) -> None:
        heapq.heappush(self.heaps[room], (cost, sequence))
        self._update(room)

    def remove(self, room: int) -> None:
        """Drop the cheapest sequence with exactly this room."""
        heapq.heappop(self.heaps[room])
        self._update(room)

    def cheapest(self, room: int) -> tuple[int, int] | None:
        """Room and name of the cheapest sequence with ``room`` or more; the fuller one on a tie."""
        low, high, best = room + self.size, 2 * self.size, (self.NONE, 0)
        tree = self.tree
        while low < high:
            if low & 1:
                best = min(best, tree[low])
                low += 1
            if high & 1:
                high -= 1
                best = min(best, tree[high])
            low >>= 1
            high >>= 1
        return None if best[0] is self.NONE or best[0][1] < 0 else (best[1], best[0][1])

    def _update(self, room: int) -> None:
        heap, at, tree = self.heaps[room], room + self.size, self.tree
        tree[at] = (heap[0] if heap else self.NONE, room)
        at >>= 1
        while at:
            tree[at] = min(tree[2 * at], tree[2 * at + 1])
            at >>= 1
