"""Near-duplicate, line and span dedup against brute force."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from compare import differences
from odd_rows import DATA, LONG, ODD
from kerbside.llm import embedding_dedup, simhash
from kerbside.llm.components import connected_components
from kerbside.llm.embedding_dedup import near_vectors
from kerbside.llm.line_dedup import dedup_lines, line_chunks
from kerbside.llm.oracles import ORACLES
from kerbside.llm.queries import QUERIES
from kerbside.llm.simhash import (
    drop_near_duplicates, fingerprint, fingerprints, grids, near_duplicates, near_links,
)
from kerbside.llm.span_dedup import dedup_spans, sentences, spans


def roots(nodes, links):
    least = {n: n for n in nodes}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def groups(pairs):
    found = defaultdict(set)
    for node, root in pairs:
        found[root].add(node)
    return {frozenset(v) for v in found.values()}


@pytest.mark.parametrize("links", [
    [(k, k + 1) for k in range(60)],
    [(0, k) for k in range(1, 80)],
    [(1, 1), (2, 3), (3, 2), (2, 3), (None, 4)],
    [(int(a), int(b)) for a, b in np.random.default_rng(1).integers(-50, 50, (60, 2))],
    [],
])
def test_components(spark, links):
    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = roots({n for link in real for n in link}, real)
    assert groups((r.node, r.root) for r in got) == groups(want.items())
    assert len(got) == len(want)


def brute_components(prints, distance):
    """Least id of each component; prints: (id, fingerprint)."""
    links = [
        (k, j) for k, (_, x) in enumerate(prints) for j, (_, y) in enumerate(prints[:k])
        if (x ^ y).bit_count() <= distance
    ]
    root = roots(range(len(prints)), links)
    members = defaultdict(list)
    for k, r in root.items():
        members[r].append(prints[k][0])
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    return Counter((prints[k][0], f"{prints[k][1]:016x}", least[root[k]]) for k in root)


def unsigned(rows):
    return Counter((r.doc_id, f"{r.fingerprint % 2**64:016x}", r.component_id) for r in rows)


@pytest.mark.parametrize("words", [4, 5])
def test_simhash_equals_brute_force(spark, documents, texts, words):
    prints = [(i, fingerprint(t, words)) for i, t in texts.items()]
    assert unsigned(near_duplicates(documents, words, 4).collect()) == brute_components(prints, 4)


def test_simhash_of_odd_rows(spark, odd):
    prints = [(i, fingerprint(t, 4)) for i, t in ODD]
    assert unsigned(near_duplicates(odd, 4, 4).collect()) == brute_components(prints, 4)
    assert near_duplicates(odd.limit(0), 4, 4).count() == 0
    kept = drop_near_duplicates(odd, 5, 4)
    assert kept.columns == odd.columns
    # 1, 2, 3 are empty; 5 copies 4; 7 copies 6, which is there twice; null ids have no better one.
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, 6, 6, None, None, 8, 9, 10])


def test_fingerprint_bits():
    import xxhash

    assert fingerprint(None, 4) == fingerprint(" \t", 4) == 0
    assert fingerprint("One  TWO", 4) == xxhash.xxh64_intdigest("one two", 42)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in ("a b c d", "b c d é")]
    assert fingerprint("a B c D é", 4) == hashes[0] & hashes[1]


def test_fingerprints_are_those_of_the_built_in_hash(spark):
    one = spark.createDataFrame([(1, "some words here")], "doc_id bigint, text string")
    assert fingerprints(one, 4).first()[1] == one.selectExpr("xxhash64(text)").first()[0]


@pytest.mark.parametrize("distance, agree", [(4, 2), (4, 3), (6, 3)])
def test_each_near_pair_meets_in_a_grid(distance, agree):
    random = np.random.default_rng(3)
    masks = [m % 2**64 for m in grids(distance, agree)]
    assert len(masks) == math.comb(distance + agree, agree)
    for _ in range(200):
        x = int(random.integers(0, 2**63))
        y = x
        for bit in random.choice(64, distance, replace=False):
            y ^= 1 << int(bit)
        p, q = (int(simhash._segment_counts(np.array([v], np.uint64))[0]) for v in (x, y))
        assert any(p & m == q & m for m in masks)


def test_large_cells_go_in_blocks(spark, monkeypatch):
    base = 0x0F0F_1234_5678_9ABC
    prints = sorted({base ^ (1 << a) ^ (1 << b) for a in range(0, 64, 2) for b in range(0, 64, 3)})
    monkeypatch.setattr(simhash, "CELL_ROWS", 40)
    table = spark.createDataFrame([(p,) for p in prints if p < 2**63], "fingerprint bigint")
    got = connected_components(near_links(table, 4))
    values = [p for p in prints if p < 2**63]
    links = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4]
    want = {n: r for n, r in roots(values, links).items()}
    assert groups((r.node, r.root) for r in got.collect()) == {
        g for g in groups(want.items()) if len(g) > 1
    }


def brute_lines(docs):
    first = {}
    count = Counter()
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0))
    distinct = {}
    for k in order:
        distinct.setdefault(docs[k], k)
    for i, t in docs:
        for c in line_chunks(t, 3):
            count["\n".join(c)] += 1
    out = {}
    for (i, t), _ in distinct.items():
        kept = []
        for c in line_chunks(t, 3):
            joined = "\n".join(c)
            if len(c) < 2 or count[joined] < 2 or first.setdefault(joined, (i, t)) is None:
                kept.append(joined)
            elif first[joined] == (i, t) and (joined, "seen") not in first:
                first[joined, "seen"] = True
                kept.append(joined)
        out[i, t] = None if t is None else "\n".join(kept)
    return Counter((i, out[i, t]) for i, t in docs)


def test_line_dedup_of_odd_rows(spark, odd):
    got = dedup_lines(odd)
    rows = got.collect()
    assert Counter((r.row.doc_id, r.new_text) for r in rows) == brute_lines(ODD)
    assert got.schema["row"].dataType.names == odd.columns
    assert dedup_lines(odd.limit(0)).count() == 0


def test_line_cuts_come_back_after_an_insert():
    lines = [f"line {k} of many" for k in range(200)]
    plain = {tuple(c) for c in line_chunks("\n".join(lines), 3)}
    moved = {tuple(c) for c in line_chunks("\n".join(["new", *lines[:90], "more", *lines[90:]]), 3)}
    assert len(plain - moved) <= 3
    assert [x for c in line_chunks("\n".join(lines), 3) for x in c] == lines
    assert line_chunks(None, 3) == [] and line_chunks("", 3) == [[""]]


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, DATA), DATA, ORACLES[name]) == []


def test_sentences_keep_the_text():
    for text in [*(t for _, t in ODD if t), "A b! C d?\nE (f.) G h. ", "\n\n x. y", "word " * 60, "..", "x\n\n\ny"]:
        pieces = sentences(text)
        assert "".join(pieces) == text
        assert all(len(p.split()) <= 24 for p in pieces)
    assert sentences("One two. Three!\nFour") == ["One two. ", "Three!\n", "Four"]


def brute_spans(docs):
    count = Counter(s for _, t in docs for _, _, s in spans(sentences(t or "")))
    order = sorted({*docs}, key=lambda d: (d[0] is None, d[0] or 0))
    seen, out = {}, {}
    for i, t in order:
        if t is None:
            out[i, t] = None
            continue
        pieces, gone = sentences(t), set()
        for first, last, s in spans(pieces):
            if count[s] > 1 and (s in seen):
                gone.update(range(first, last + 1))
            seen.setdefault(s, i)
        out[i, t] = "".join(p for k, p in enumerate(pieces) if k not in gone)
    return Counter((i, out[i, t]) for i, t in docs)


def test_span_dedup_equals_brute_force(spark, documents, texts, odd):
    docs = list(texts.items())
    got = Counter((r.row.doc_id, r.new_text) for r in dedup_spans(documents).collect())
    assert got == brute_spans(docs)
    assert Counter((r.row.doc_id, r.new_text) for r in dedup_spans(odd).collect()) == brute_spans(ODD)
    assert dedup_spans(odd.limit(0)).count() == 0


def test_passages_inside_long_sentences_go_wherever_they_begin(spark):
    deal = np.random.default_rng(8)
    own = lambda n: [f"w{x}" for x in deal.integers(0, 10**9, n)]
    docs, passages = [], []
    for size in range(50, 61):
        passages.append(own(size))
        docs += [
            (5 * size + k, " ".join([*own(before), *passages[-1], *own(40)]) + ".")
            for k, before in enumerate((0, 5, 11, 17, 30))
        ]
    got = {r.row.doc_id: r.new_text.split() for r in dedup_spans(
        spark.createDataFrame(docs, "doc_id bigint, text string")
    ).collect()}
    left = total = 0
    for k, (i, text) in enumerate(docs):
        if k % 5 == 0:
            assert got[i] == text.split()
        else:
            passage = set(passages[k // 5])
            total += len(passage)
            left += len(passage.intersection(got[i]))
            kept = [w for w in text.rstrip(".").split() if w not in passage]
            assert [w.rstrip(".") for w in got[i] if w.rstrip(".") not in passage] == kept
    assert left < total / 3


def test_loops_of_one_word_are_cut():
    for word in ("yes", "no", "loop", "x"):
        pieces = sentences(f"{word} " * 200)
        assert "".join(pieces) == f"{word} " * 200
        assert all(len(p.split()) <= 24 for p in pieces) and len(pieces) > 8


def test_span_dedup_takes_a_shared_passage_only(spark):
    passage = " ".join(f"Sentence {k} of the passage has some seven words." for k in range(7))
    alone = " ".join("w%d" % k for k in range(55))  # without a full stop
    rows = [
        (1, f"First of its own. {passage} Then more of one."), (2, f"Other start! {passage} Other end."),
        (3, "Short. Same. Words."), (4, "Short. Same. Words."), (5, f"Before.\n{alone}\nafter"), (6, f"x\n{alone}\ny"),
    ]
    got = {r.row.doc_id: r.new_text for r in dedup_spans(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1] == rows[0][1] and got[2] == "Other start! Other end."
    assert got[3] == got[4] == "Short. Same. Words."
    assert got[5] == rows[4][1] and len(got[6].split()) < 12


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, values string")


def brute_vectors(rows, cosine=0.9):
    def fit(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = Counter()
    pairs = []
    for k, (_, v) in enumerate(rows):
        for j, (_, w) in enumerate(rows):
            if j != k and fit(v) and fit(w) and len(v) == len(w):
                x, y = np.float32(v).astype(float), np.float32(w).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                    links[k] += 1
                    pairs.append((k, j))
    root = roots(range(len(rows)), pairs)
    least = {}
    for k, r in root.items():
        if rows[k][0] is not None:
            least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    return Counter((rows[k][0], links[k], least.get(root[k])) for k in root)


def test_vectors_equal_brute_force(spark, monkeypatch):
    random = np.random.default_rng(5)
    centres = random.standard_normal((40, 16))
    rows = [(k, (centres[k % 40] + 0.25 * random.standard_normal(16)).tolist()) for k in range(300)]
    rows += [(1000 + k, rows[0][1]) for k in range(50)]
    rows += [
        (2000, None), (2001, [0.0] * 16), (2002, [float("nan")] + [1.0] * 15), (2003, [None] + [1.0] * 15),
        (2004, []), (2005, [1.0, 2.0]), (2006, [2.0, 4.0]), (None, [1.0, 2.1]), (2007, [float("inf")] + [1.0] * 15),
        (2005, [1.0, 2.0]), (2008, [1e-30] * 16), (2009, [3e30] * 16),
    ]
    monkeypatch.setattr(embedding_dedup, "LEAF_ROWS", 40)
    for block in (2048, 50):
        monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", block)
        got = near_vectors(vectors(spark, [(*r, "x") for r in rows])).collect()
        assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == brute_vectors(rows)
        assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert near_vectors(vectors(spark, [])).count() == 0


def test_long_texts_are_folded(spark, odd):
    got = {r.row.doc_id: r.new_text for r in dedup_spans(odd).collect()}
    assert len(got[4]) < len(LONG) and got[5].strip() == ""
