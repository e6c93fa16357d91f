"""Alignment of two tokenizers against a plain merge, token by token."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kerbside.llm import alignment
from kerbside.llm.alignment import (
    align_documents, aligner, lanes, pair_counts, piece_words, score_links,
)
from kerbside.llm.queries import QUERIES
from odd_rows import DATA, LONG, ODD

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@cache
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


@cache
def spelled():
    """Each id's bytes, from the vocabularies themselves."""
    a, b = libraries()
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in plain}
    letters |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
    of_a = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab().items()}
    of_b = {
        i: bytes([i - 3]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in range(b.get_piece_size())
    }
    return of_a, of_b


@cache
def brute(text):
    """Groups of (A ids, B ids) by walking both token lists; none without tokens."""
    if not text:
        return []
    a, b = libraries()
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    of_a, of_b = spelled()
    spaced = (" " + text).encode()
    if b"".join(of_a[i] for i in x) != spaced or b"".join(of_b[i] for i in y) != spaced:
        return []

    def ends(ids, of):
        out, at = [], 0
        for i in ids:
            at += len(of[i])
            out.append(at)
        return out

    x_ends, y_ends = ends(x, of_a), ends(y, of_b)
    common = set(x_ends) & set(y_ends)

    def parts(ids, ids_ends):
        own, out = [], []
        for i, end in zip(ids, ids_ends):
            own.append(i)
            if end in common:
                out.append(own)
                own = []
        return out

    return list(zip(parts(x, x_ends), parts(y, y_ends)))


def written(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def link_counts(groups):
    return Counter((i, j) for x, y in groups for i in x for j in y)


TEXTS = [
    None, "", " ", "  ", "\n", "a", "x ", " x", "x  y", "a\nb", "a\n b \n", "hello world.\nSo, it's 12345!", "▁x", "a▁ b",
    "日本語 テキスト。", "é́ ẞ ﬁ", "\x00 \x01 \t", "<|endoftext|> <s> </s> <0x41>", "﻿abc", "a\xa0b", "\U0001F600\U0001F468",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "=" * 300, "    code\n        more", "\r\n",
]


def checked(texts):
    got = aligner(A, B).align(texts).to_pylist()
    for text, r in zip(texts, got):
        groups = brute(text)
        links = link_counts(groups)
        assert r["groups"] == written(groups)
        assert r["n_a"] == sum(len(x) for x, _ in groups) and r["n_b"] == sum(len(y) for _, y in groups)
        assert r["n_groups"] == len(groups) and r["n_links"] == sum(links.values())
        assert {(p >> 32, p & 0xFFFFFFFF): t for p, t in zip(r["pairs"], r["times"])} == links


def test_odd_texts():
    checked(TEXTS)
    checked(TEXTS[::-1])
    for text in TEXTS:
        checked([text])
    checked([])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aé .,'\n\t1—日\x85▁x", max_size=40), max_size=6))
def test_any_texts(texts):
    checked(texts)


@pytest.mark.parametrize("group, lane", [(1, 1), (2, 7), (64, 512)])
def test_large_groups_and_short_lanes(texts, monkeypatch, group, lane):
    monkeypatch.setattr(alignment, "SMALL_GROUP", group)
    monkeypatch.setattr(lanes, "__defaults__", (lane,))
    some = sorted(texts.values(), key=len)[:120]
    assert any(len(lanes(" " + t)) > 3 for t in some) or lane == 512
    checked(some + TEXTS)


def test_lockstep_takes_as_many_steps_as_the_longest_lane():
    own = aligner(A, B)
    text = "one two three " * 50
    a = np.frombuffer(own.a.encode(" " + text), "<u4").astype(np.int64)
    b = own.b.encode(" " + text).astype(np.int64)
    lane_counts = []
    for n in (1, 40):
        steps = list(alignment.lockstep(
            np.cumsum(np.tile(own.a_lengths[a], n)), np.cumsum(np.tile(own.b.lengths[b], n)),
            np.arange(n + 1) * len(a), np.arange(n + 1) * len(b),
        ))
        lane_counts.append((len(steps), sum(len(g.a_from) for g, _, _ in steps) // n))
    assert lane_counts[0] == lane_counts[1]


def test_words_are_only_cut_where_the_vocabulary_allows_it():
    own = piece_words(B)
    assert own._by_word
    pieces = [own._model.id_to_piece(i) for i in range(own._model.get_piece_size())]
    assert not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)


def brute_table(rows):
    found = [(i, brute(t)) for i, t in rows]
    n = Counter(p for _, groups in found for p in link_counts(groups))
    most = defaultdict(int)
    for (a, _), docs in n.items():
        most[a] = max(most[a], docs)
    out = []
    for i, groups in found:
        links = link_counts(groups)
        out.append((
            i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups),
            sum(links.values()), sum(t for p, t in links.items() if n[p] == most[p[0]]),
            sum(t * n[p] for p, t in links.items()),
            hashlib.sha256(written(groups).encode()).hexdigest() if groups else "",
        ))
    return Counter(out)


@pytest.mark.parametrize("frequent", [0, 50, 131_072])
def test_query_equals_brute_force(spark, texts, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT_PAIRS", frequent)
    got = QUERIES["op13_alignment"](spark, DATA)
    assert got.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    assert Counter(map(tuple, got.collect())) == brute_table(texts.items())


def test_odd_rows(spark, odd):
    rows = odd.where("doc_id is null or doc_id not in (4, 5)")
    aligned = align_documents(rows, A, B)
    got = aligned.collect()
    assert all(r.row.asDict().keys() == set(odd.columns) for r in got)
    assert Counter((r.row.doc_id, r.groups) for r in got) == Counter(
        (i, written(brute(t))) for i, t in ODD if t != LONG
    )
    scored = score_links(aligned.withColumn("key", aligned["row.doc_id"]), pair_counts(aligned), "key")
    assert {r.key for r in scored.collect()} == {None, 3, 6, 7, 8, 9, 10}
    assert align_documents(odd.limit(0), A, B).count() == 0
    long = align_documents(odd.where("doc_id in (4, 5)"), A, B).collect()
    assert len({r.groups for r in long}) == 1 and long[0].n_links > 60_000
