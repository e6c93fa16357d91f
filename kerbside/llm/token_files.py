"""Token ids in binary files: frequency ranks, byte-aligned, with the control bytes apart.

A shard file is a header (magic, documents, ids, bytes of the index, of the controls, of the data),
an index (Arrow stream of each document's id and number of ids), the control bytes and the data
bytes. A control byte holds, for four ids, two bits each: how many bytes the id's rank takes, less
one; the ranks' bytes follow each other in the data, low byte first. ``ranks.bin`` beside the shards
lists the ids by rank as unsigned little-endian 32-bit integers.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from kerbside.llm.common import saved
from kerbside.llm.tokens import SpacedWords, encoder

MAGIC = b"TOKRANK1"
HEADER = "<8s5Q"
SHARD_IDS = 4_000_000
ID_BYTES = 4

# What a control byte says: the bytes of each of its four ids.
WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[:len(ranks)] = extra
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(ID_BYTES) <= extra[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, ID_BYTES)[used].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks again: each control byte looked up for its four widths."""
    widths = WIDTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(widths, dtype=np.int64)
    padded = np.frombuffer(data + bytes(ID_BYTES), np.uint8)
    at = ends - widths
    ranks = padded[at].astype(np.uint32)
    for byte in range(1, ID_BYTES):
        wide = np.flatnonzero(widths > byte)
        ranks[wide] |= padded[at[wide] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


def _filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


def _write(path: str, content: list[bytes]) -> None:
    system, place = _filesystem(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    with system.open_output_stream(place) as out:
        for part in content:
            out.write(part)


def _read(path: str) -> bytes:
    system, place = _filesystem(path)
    with system.open_input_file(place) as f:
        return f.read()


def token_ids(docs: DataFrame, vocabulary: str, end_id: int, form: str) -> DataFrame:
    """``(doc_id, ids)``: each whole text's ids and ``end_id``, as numbers of the numpy ``form``."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", T.BinaryType())])
    end = end_id.to_bytes(ID_BYTES, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(SpacedWords, vocabulary).encode
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                ids = [to_ids(text or "") + end for text in batch.column(1).to_pylist()]
                # One buffer for all of them.
                narrow = np.frombuffer(b"".join(ids), "<u4").astype(form)
                ends = np.cumsum([0, *map(len, ids)]) // ID_BYTES * narrow.itemsize
                column = pa.Array.from_buffers(
                    pa.binary(), len(ids),
                    [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(narrow)],
                )
                yield pa.RecordBatch.from_arrays([batch.column(0), column], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def ids_by_rank(tokens: DataFrame, form: str) -> np.ndarray:
    """All ids that occur, the most frequent first; as many as the vocabulary has at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            new = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), form))
            if len(new) > len(total):
                total = np.pad(total, (0, len(new) - len(total)))
            total[:len(new)] += new
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(total[found])], names=["id", "n"]
        )

    counts = tokens.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(
        F.sum("n").alias("n")
    ).toArrow()
    ids, n = np.asarray(counts["id"]), np.asarray(counts["n"])
    return ids[np.lexsort((ids, -n))].astype("<u4")


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0
) -> DataFrame:
    """Write all ``docs`` in ascending ``doc_id`` order below ``folder``; the list of its shards.

    ``(part, shard, path, n_ids)``: shards follow each other by ``(part, shard)``. ``folder`` is one
    all executors reach. A task that runs twice writes other files, and only those of the run that
    counts are listed. Null and empty texts are their end id alone; null ids come first; repeated
    rows are written each. An empty table gives no shard.
    """
    # Two bytes an id where they do: this table and its shuffle are most of what is moved.
    form = "<u2" if Tokenizer.from_file(vocabulary).get_vocab_size() <= 1 << 16 else "<u4"
    tokens = saved(token_ids(docs, vocabulary, end_id, form), "token-ids", "zstd")
    by_rank = ids_by_rank(tokens, form)
    _write(f"{folder}/ranks.bin", [by_rank.tobytes()])
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        n_held = 0
        for batch in batches:
            for doc, text_ids in zip(batch.column(0), batch.column(1).to_pylist()):
                ids = np.frombuffer(text_ids, form)
                held.append((doc, ids))
                n_held += len(ids)
                if n_held >= SHARD_IDS:
                    yield flush(part, shard, held)
                    held, n_held, shard = [], 0, shard + 1
        if held:
            yield flush(part, shard, held)

    def flush(part: int, shard: int, held: list[tuple]) -> pa.RecordBatch:
        ids = np.concatenate([ids for _, ids in held])
        control, data = encode_ranks(rank_of[ids])
        index = pa.table({
            "doc_id": pa.array([doc.as_py() for doc, _ in held], held[0][0].type),
            "n_ids": pa.array([len(ids) for _, ids in held], pa.int64()),
        })
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as writer:
            writer.write_table(index)
        listed = sink.getvalue().to_pybytes()
        path = f"{folder}/{part:06d}-{shard:06d}-{uuid.uuid4().hex}.tok"
        header = struct.pack(HEADER, MAGIC, len(held), len(ids), len(listed), len(control), len(data))
        _write(path, [header, listed, control, data])
        return pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
            "path": [path], "n_ids": pa.array([len(ids)], pa.int64()),
        })

    ordered = tokens.repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id")
    return saved(
        ordered.mapInArrow(shards, "part int, shard int, path string, n_ids bigint"), "shards"
    )


def read_token_files(spark: SparkSession, shards: DataFrame, folder: str, id_type: T.DataType) -> DataFrame:
    """``(doc_id, start, ids)`` from the listed shard files; ``start`` counts all ids before."""
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = F.coalesce(
        F.sum("part_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.join(parts.select("part", before.alias("base")), "part").select(
        "path", (F.col("base") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("start")
    )
    by_rank = np.frombuffer(_read(f"{folder}/ranks.bin"), "<u4")
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("start", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                index, ids = read_shard(_read(path), by_rank)
                ends = np.cumsum(np.asarray(index["n_ids"]))
                begins = ends - np.asarray(index["n_ids"])
                for at in range(0, len(index), 1_000):
                    stop = min(at + 1_000, len(index))
                    yield pa.RecordBatch.from_arrays([
                        pa.concat_arrays(index["doc_id"].slice(at, 1_000).chunks),
                        pa.array(begins[at:stop] + start),
                        pa.array([ids[b:e].tobytes() for b, e in zip(begins[at:stop], ends[at:stop])], pa.binary()),
                    ], names=schema.names)

    # A given number of tasks: told the key alone, Spark would gather the few small rows in one.
    return placed.repartition(max(1, shards.count()), "path").mapInArrow(read, schema)


def read_shard(content: bytes, by_rank: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """The index of a shard file and its ids."""
    magic, _, n_ids, n_index, n_control, n_data = struct.unpack_from(HEADER, content)
    if magic != MAGIC:
        raise ValueError("not a token file")
    view = memoryview(content)[struct.calcsize(HEADER):]
    index = pa.ipc.open_stream(view[:n_index]).read_all()
    control = bytes(view[n_index:n_index + n_control])
    data = bytes(view[n_index + n_control:n_index + n_control + n_data])
    return index, by_rank[decode_ranks(control, data, n_ids)]
