"""The registered queries as they are, on whole small tables, against rules written out here."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from kerbside.llm import gru
from kerbside.llm.queries import QUERIES
from odd_rows import DATA
from test_dedup import brute_spans


def ids_of(name, text, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return [np.array([*e.ids, end], "<u4") for e in tokenizer.encode_batch(text, add_special_tokens=False)]


def test_packing(spark, texts):
    got = QUERIES["op2_packing"](spark, DATA)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert [t for _, t in got.dtypes][1:] == ["bigint"] * 6
    own = dict(zip(texts, ids_of("word_bpe_49k.json", [t or "" for t in texts.values()], 1)))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got.collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        ids = own[r.doc_id][r.start:r.start + r.length]
        assert r.length == len(ids) > 0 and r.ids_crc32 == zlib.crc32(ids.tobytes())
        assert r.doc_tokens == len(own[r.doc_id])
    for doc, pieces in by_doc.items():
        ends = np.cumsum([0, *(r.length for r in sorted(pieces, key=lambda r: r.start))]).tolist()
        assert sorted(r.start for r in pieces) == ends[:-1] and ends[-1] == len(own[doc])
    padded = 0
    for pieces in by_sequence.values():
        ends = np.cumsum([0, *(r.length for r in sorted(pieces, key=lambda r: r.offset))]).tolist()
        assert sorted(r.offset for r in pieces) == ends[:-1] and ends[-1] <= 2048
        padded += 0 if ends[-1] & (ends[-1] - 1) == 0 else 2048 - ends[-1]
    assert by_doc.keys() == texts.keys() and padded == 0


@pytest.mark.parametrize("folder", [DATA, DATA.replace("0.001", "0.1")])
def test_embedding_dedup(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, vectors = zip(*sorted(
        (r.vec_id, next(v for v in r if isinstance(v, list))) for r in rows
        if any(isinstance(v, list) for v in r)
    ))
    x = np.array([[np.nan if c is None else c for c in v] for v in vectors], np.float64)
    norms = np.linalg.norm(x, axis=1)
    sound = np.isfinite(norms) & (norms > 0)
    x[sound] /= norms[sound, None]
    x[~sound] = 0
    links = x @ x.T >= 0.9
    np.fill_diagonal(links, False)
    root = np.arange(len(ids))
    while True:  # the least place reachable, one step at a time
        least = np.minimum(root, np.where(links, root[None, :], len(ids)).min(axis=1, initial=len(ids)))
        if (least == root).all():
            break
        root = least
    got = {r.vec_id: tuple(r)[1:] for r in QUERIES["op3_embedding_dedup"](spark, folder).collect()}
    want = {
        i: (int(links[k].sum()), ids[root[k]], ids[root[k]] == i) for k, i in enumerate(ids)
    }
    # No link that is none, and of those that are, by the rows whose id is divisible by 20, nearly all.
    assert got.keys() == {r.vec_id for r in rows}
    assert all(got[i][0] <= want[i][0] for i in ids)
    asked = [i for i in ids if i % 20 == 0]
    found, all_links = sum(got[i][0] for i in asked), sum(want[i][0] for i in asked)
    assert found >= 0.99 * all_links
    if found == all_links and all(got[i][0] == want[i][0] for i in ids):
        assert all(got[i] == want[i] for i in ids)


def test_simhash(spark, texts):
    def fingerprint(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall("[^\x20\x09-\x0D]+", lowered)
        shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {i: fingerprint(t) for i, t in texts.items()}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if (prints[i] ^ prints[j]).bit_count() <= 4 and root[j] < root[i]:
                    root[i], changed = root[j], True
    got = QUERIES["op4_simhash"](spark, DATA)
    assert {tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()} == {
        (i, f"{prints[i]:016x}", root[i]) for i in prints
    }


def test_token_files(spark, texts):
    got = sorted(QUERIES["op6_token_files"](spark, DATA).collect(), key=lambda r: r.start)
    order = sorted(texts)
    own = ids_of("byte_bpe_50k.json", [texts[i] or "" for i in order], 0)
    starts = np.cumsum([0, *map(len, own)]).tolist()
    assert [tuple(r) for r in got] == [
        (i, s, len(ids), zlib.crc32(ids.tobytes())) for i, s, ids in zip(order, starts, own)
    ]


def test_span_dedup(spark, texts):
    got = QUERIES["op9_span_dedup"](spark, DATA)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == brute_spans(list(texts.items()))
    for r in got.collect():
        assert (r.n_removed > 0) == (r.text != texts[r.doc_id]) and r.n_removed <= r.n_sentences


def test_gradients_through_time():
    """What one update moves parameters by, against differences of the loss over its window."""
    rng = np.random.default_rng(11)
    start = gru.initial(rng.integers(1, 50, 5).astype(float), rng.integers(1, 9, (5, 4)).astype(float))
    start["class_w"] = rng.normal(0, 0.5, start["class_w"].shape).astype(np.float32)
    start["slot_w"] = rng.normal(0, 0.5, start["slot_w"].shape).astype(np.float32)
    steps, lanes = 6, 3
    grid = rng.integers(0, 20, (steps, lanes))
    begins = np.zeros((steps, lanes), bool)
    begins[3, 1] = True
    h0 = rng.normal(0, 0.5, (lanes, gru.HIDDEN)).astype(np.float32)

    def loss(p):
        h, total = h0, 0.0
        for symbols, new in zip(grid, begins):
            h = np.where(new[:, None], np.float32(0), h)
            total -= gru.log_likelihood(p, h, symbols).astype(float).sum()
            h, _ = gru._step(p, symbols, h)
        return total / lanes

    p = {k: v.copy() for k, v in start.items()}
    memory = {k: np.full(v.shape, 1e-2, np.float32) for k, v in p.items()}
    gru._update(p, memory, grid, begins, h0)
    checked = 0
    for name in ("state", "inputs", "class_w", "slot_w", "slot_b"):
        moved = (start[name] - p[name]).astype(float) / gru.RATE
        slope = 0.1 * moved / np.sqrt(1 - np.minimum(moved ** 2, 0.9999))  # Adagrad's step undone
        for place in zip(*(rng.integers(0, n, 25) for n in start[name].shape)):
            if abs(moved[place]) > 0.99:
                continue  # too steep to be undone
            sides = []
            for delta in (1e-2, -1e-2):
                q = {k: v.copy() for k, v in start.items()}
                q[name][place] += delta
                sides.append(loss(q))
            assert abs((sides[0] - sides[1]) / 2e-2 - slope[place]) < 2e-3 + 0.02 * abs(slope[place])
            checked += 1
    assert checked > 80
