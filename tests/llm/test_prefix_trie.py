"""The trie of conversations against one built turn by turn in dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import prefix_trie as module
from kerbside.llm.prefix_trie import (
    Rows, conversation_paths, lexicographic, levels, prefix_trie, with_shared_heads,
)
from kerbside.llm.queries import QUERIES
from odd_rows import DATA

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute_paths(rows):
    """Conversations' turns in order; rows are (conv_id, turn, role, text)."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns, key=order)] for c, turns in found.items()}


def order(turn):
    name = f"{len(turn[2])}:{turn[2]}{turn[3]}"
    return (*turn[:2], hashlib.sha256(name.encode()).hexdigest()[:32])


def brute_rebuilt(paths):
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = paths.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute_trie(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    rows = Counter()
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = own + sum(saved[x] for x in children[node])
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(paths[c]) == len(node))
        rows[(
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )] += 1
    return rows


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect()]
    got = QUERIES["op11_prefix_trie"](spark, DATA)
    assert got.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    assert Counter(map(tuple, got.collect())) == brute_trie(brute_rebuilt(brute_paths(rows)))


def conversations(seed, n, deep):
    """Conversations that share beginnings, many of them equal, one very long; some odd rows."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        c = c * 7 % (3 * n)
        size = deep if c == 7 else 0 if rng.random() < 0.1 else rng.randrange(7)
        turns = ["x"] * size if c % 3 == 0 else [rng.choice("xyz") for _ in range(size)]
        rows += [(c, k, rng.choice(["user", "user", "bot"]), t * (k % 4)) for k, t in enumerate(turns)]
    rows += [(3, None, "user", None), (3, None, None, "b"), (3, 2, "user", "x"), (3, 2, "user", "x")]
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None)]
    rows += [(5_000, 0, "a", "bc"), (5_001, 0, "ab", "c"), (5_002, 0, "", "abc"), (6_055, 1, "u", "é\U0001F600")]
    return rows


@pytest.mark.parametrize("shard, blocks", [(1, 2), (7, 16), (40, 3), (10**6, 1)])
def test_any_shards(spark, monkeypatch, shard, blocks):
    monkeypatch.setattr(module, "SHARD_TURNS", shard)
    monkeypatch.setattr(module, "DEPTH_BLOCK", blocks)
    monkeypatch.setattr(module, "MAX_SHARDS", 40)
    rows = conversations(shard, 150, 53)
    clashing = "seq string, sizes string, n string, ends string, key string, shard int, side int"
    frame = spark.createDataFrame([(*r, *["x"] * 5, 1, 1) for r in rows], f"{SCHEMA}, {clashing}")
    paths = conversation_paths(frame)
    wanted = brute_paths(rows)
    assert {r.conv_id: len(r.path) for r in paths.collect()} == {c: len(p) for c, p in wanted.items()}
    assert Counter(map(tuple, prefix_trie(paths).collect())) == brute_trie(wanted)
    rebuilt = with_shared_heads(paths, 100, 6)
    assert Counter(map(tuple, prefix_trie(rebuilt).collect())) == brute_trie(brute_rebuilt(wanted))


def test_none_and_only_empty_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(conversation_paths(empty)).count() == 0
    turnless = spark.createDataFrame([(4, []), (2, [])], "conv_id bigint, path array<struct<name string, size int>>")
    ends = hashlib.sha256(b"2,4").hexdigest()
    assert [tuple(r) for r in prefix_trie(turnless).collect()] == [(2, 0, None, 2, 0, 1, 0, ends)]


def test_a_hot_path_is_hashed_from_runs_of_many_tasks(spark):
    n = 30_000
    paths = spark.range(n).selectExpr(
        "id AS conv_id",
        "array(named_struct('name', if(id % 3 = 0, lpad('', 32, 'a'), lpad(hex(id), 32, '0')), 'size', 2)) AS path",
    )
    got = {r.n: r for r in module.folded(paths).where("n > 1").collect()}
    ids = ",".join(str(i) for i in range(0, n, 3))
    assert got.keys() == {n // 3}
    assert got[n // 3].ends == hashlib.sha256(ids.encode()).hexdigest() and got[n // 3].conv_id == 0


paths_of_ids = st.lists(st.lists(st.integers(1, 3), max_size=9), min_size=1, max_size=25)


@settings(max_examples=200, deadline=None)
@given(paths_of_ids, st.integers(1, 5))
def test_matrix_order_and_nodes(paths, block):
    before, module.DEPTH_BLOCK = module.DEPTH_BLOCK, block
    try:
        depths = np.array([len(p) for p in paths], np.int64)
        rows = Rows(np.array([i for p in paths for i in p], np.int32), depths, np.cumsum(depths) - depths)
        order = lexicographic(rows)
        ordered = [paths[i] for i in order]
        assert ordered == sorted(paths)
        rows = Rows(rows.ids, rows.depths[order], rows.starts[order])
        for depth, members, starts in levels(rows):
            assert members.tolist() == [i for i, p in enumerate(ordered) if len(p) >= depth]
            firsts = {}
            for i in members.tolist():
                firsts.setdefault(tuple(ordered[i][:depth]), i)
            assert members[starts].tolist() == sorted(firsts.values())
    finally:
        module.DEPTH_BLOCK = before
