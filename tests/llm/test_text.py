"""Language id, packing, token files, scores, personal data and decontamination against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import sys
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kerbside.llm import decontaminate, gru, langid, lm_score, packing, pii
from kerbside.llm.decontaminate import contamination, drop_contaminated
from kerbside.llm.queries import QUERIES, op8_pii
from kerbside.llm.token_files import decode_ranks, encode_ranks, read_token_files, write_token_files
from kerbside.llm.tokens import LowerWords, SpacedWords, encoder, evenly_spaced
from kerbside.session import scratch_path
from odd_rows import DATA, LONG, ODD

LOWER, SPACED = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json"))


@cache
def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def plain_ids(path, text):
    return library(path).encode(text, add_special_tokens=False).ids


ODD_TEXTS = [
    "", " ", "a  b", "x\n\ny", " lead", "trail ", "tab\there", "it's I'LL don't 'S 're", "Éá é́x",
    "a\x1cb \x85 c", "a\x01b", "12345 ab12 <|endoftext|> x", "ﬁ İstanbul ẞ ΑΣ ΟΔΟΣ", "\n", "a \n b",
    "naïve—dash…", "日本語 テキスト。", "x\r\ny", "a.b,c .d ,e ., ... !. .! _. ._ (f.) 'g.' 1.5 2,000.", ".start",
    "end,", "a.́b", "a b. c",
]


@pytest.mark.parametrize("kind, path", [(LowerWords, LOWER), (SpacedWords, SPACED)])
def test_cached_words_give_the_library_s_ids(kind, path, texts):
    encode = encoder(kind, path).encode
    for text in ODD_TEXTS + list(texts.values())[:60]:
        assert np.frombuffer(encode(text), "<u4").tolist() == plain_ids(path, text)


def test_words_are_kept_once():
    words = LowerWords(LOWER)
    ids = words.encode("The cat sat, and (the) cat's 2 hats a.b") + words.encode("Une fée, là")
    assert np.frombuffer(ids, "<u4").tolist() == [
        *plain_ids(LOWER, "The cat sat, and (the) cat's 2 hats a.b"), *plain_ids(LOWER, "Une fée, là")
    ]
    assert {"and", "fée"} <= words._words.keys()
    assert not words._pieces.keys() & words._words.keys() & {"and", "sat", "hats", "une", "fée"}


def test_texts_go_to_python_once(spark, capsys):
    rows = spark.createDataFrame([(1, "some words")], "doc_id bigint, Text string")
    found = langid.identify(rows, langid.LanguageModel({"en": "some other words", "fr": "rien"}))
    assert [(r.row.Text, r.lang_pred) for r in found.collect()] == [("some words", "en")]
    found.explain()
    sent = re.search(r"MapInArrow predict\(([^)]*)\)", capsys.readouterr().out)[1]
    assert len(sent.split(",")) == 1


@given(st.text(st.sampled_from("ab.\u00e9 \n\t\x01\x1c\x85\xa0\u2028\u3000\u200b"), max_size=8))
def test_even_spacing_is_told_as_by_splitting(text):
    words, between = text.split(), text.count(" ") + text.count("\n")
    even = len(words) == between + 1 and sum(map(len, words)) + between == len(text)
    assert evenly_spaced(text) == (even and "\x01" not in text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aBé .,!'_\n\t1 —s", max_size=30))
def test_cached_words_of_any_text(text):
    for kind, path in ((LowerWords, LOWER), (SpacedWords, SPACED)):
        assert np.frombuffer(encoder(kind, path).encode(text), "<u4").tolist() == plain_ids(path, text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=40))
def test_ranks_come_back(values):
    ranks = np.array(values, np.uint32)
    control, data = encode_ranks(ranks)
    assert len(control) == -(-len(values) // 4)
    assert decode_ranks(control, data, len(values)).tolist() == values


def test_token_files_round_trip(spark, odd, documents, texts):
    for docs, rows in ((odd, ODD), (documents, list(texts.items()))):
        folder = scratch_path(spark, "tokens")
        shards = write_token_files(docs, folder, SPACED, end_id=0)
        got = read_token_files(spark, shards, folder, docs.schema["doc_id"].dataType).collect()
        ids = {t: [*plain_ids(SPACED, t or ""), 0] for _, t in rows if t != LONG}
        start = 0
        for r in sorted(got, key=lambda r: r.start):
            assert r.start == start
            start += len(r.ids) // 4
        assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted(
            [i for i, _ in rows], key=lambda i: (i is not None, i)
        )
        short = Counter((r.doc_id, r.ids) for r in got if len(r.ids) < 200_000)
        assert short == Counter((i, np.array(ids[t], "<u4").tobytes()) for i, t in rows if t != LONG)
    empty = write_token_files(odd.limit(0), f"{folder}-none", SPACED)
    assert read_token_files(spark, empty, f"{folder}-none", odd.schema["doc_id"].dataType).count() == 0


def check_packing(rows, texts, capacity=2048):
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        end = 0
        for r in pieces:
            assert r.offset == end and r.length > 0
            end += r.length
        assert end <= capacity and end & (end - 1) == 0  # nothing is padded
    for doc, text in texts.items():
        want = [*plain_ids(LOWER, text or ""), 1]
        pieces = sorted(by_doc[doc], key=lambda r: r.start)
        assert b"".join(r.ids for r in pieces) == np.array(want, "<u4").tobytes()
        assert [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
        assert {r.doc_tokens for r in pieces} == {len(want)}


def test_packing(spark, documents, texts, odd, monkeypatch):
    check_packing(packing.pack_documents(documents, LOWER).collect(), texts)
    monkeypatch.setattr(packing, "GROUP_CHARS", 50_000)
    check_packing(packing.pack_documents(documents, LOWER).collect(), texts)
    single = odd.where("doc_id not in (6)")
    check_packing(packing.pack_documents(single, LOWER).collect(), {i: t for i, t in ODD if i not in (None, 6)})
    repeated = packing.pack_documents(odd, LOWER).where("doc_id is null or doc_id = 6").count()
    assert repeated >= 4
    assert packing.pack_documents(odd.limit(0), LOWER).count() == 0


def test_packing_balances_cost():
    random = np.random.default_rng(2)
    lengths = random.integers(1, 1200, 800).tolist()
    cost = defaultdict(float)
    for _, _, n, sequence, _ in packing.assign(lengths, 2048):
        cost[sequence] += packing.LINEAR * n + packing.QUADRATIC * n * n
    full = list(cost.values())[: sum(lengths) // 2048]
    assert max(full) < 1.25 * min(full)


def longest(text, sample):
    n = 0
    while n < len(text) and text[:n + 1] in sample:
        n += 1
    return n


def test_parsing_takes_longest_matches():
    samples = {"x": "abracadabra alakazam", "y": "the quick brown fox jumps over the lazy dog"}
    model = langid.LanguageModel(samples)
    for text in ("abra the fox", "zzz", "quick brownies alakazoo!", "q" * 2000, "ñandú fox"):
        symbols = model.symbols(text)
        got = model.phrases([symbols, symbols[:0]])
        for k, lang in enumerate(model.langs):
            known = "".join(map(chr, model.symbols(samples[lang])))
            count = 0
            for start in range(0, len(symbols), langid.WINDOW):
                rest = "".join(map(chr, symbols[start:start + langid.WINDOW]))
                while rest:
                    rest = rest[max(1, longest(rest, known)):]
                    count += 1
            assert got[k].tolist() == [count, 0]


def test_alphabets_of_any_size(monkeypatch):
    random = np.random.default_rng(4)
    hangul = [chr(0xAC00 + k) for k in range(400)]
    samples = {
        "ko": " ".join("".join(random.choice(hangul, 3)) for _ in range(3_000)),
        "en": "the quick brown fox jumps over the lazy dog and runs away " * 30,
    }
    assert len({c for c in samples["ko"]}) > 390
    texts = [samples["ko"][1_000:1_400], "the lazy fox", samples["ko"][:90] + " fox", "日本 the"]
    model = langid.LanguageModel(samples)
    dense = model.phrases([model.symbols(t) for t in texts])
    monkeypatch.setattr(langid, "DENSE_ENTRIES", 0)
    sparse = langid.LanguageModel(samples)
    assert (sparse.phrases([sparse.symbols(t) for t in texts]) == dense).all()
    assert model.predict(texts)[0] == ["ko", "en", "ko", "en"]
    # A part of a sample is one phrase for its language, whatever the other's alphabet.
    assert dense[model.langs.index("ko")][0] == 1 and dense[model.langs.index("en")][1] == 2


def test_language_id(spark, documents, odd):
    got = QUERIES["op7_language_id"](spark, DATA).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == documents.count() and len(held) > 30
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    model = langid.fit(documents)
    rows = langid.identify(odd, model).collect()
    assert {r.row.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 3, 8}
    assert len(rows) == len(ODD) and rows[0].row.asDict().keys() == set(odd.columns)
    unlabelled = langid.identify(odd, langid.fit(odd)).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    assert langid.identify(odd.limit(0), model).count() == 0


def test_copies_take_nothing_from_the_sample(spark):
    copies = spark.range(200_000).selectExpr("repeat('hot text of many copies ', 160) text", "'aa' lang")
    others = spark.range(100).selectExpr("concat('other text ', id, repeat(' of this label', 25)) text", "'aa' lang")
    sample = langid.labelled_sample(copies.unionAll(others))
    assert sample["aa"].count("other text") == 100 and "hot text" in sample["aa"]


def test_gradients():
    random = np.random.default_rng(0)
    p = gru.initial(random.integers(1, 50, 5).astype(float), random.integers(1, 9, (5, 4)).astype(float))
    p = {k: (v + random.normal(0, 0.3, v.shape)).astype(np.float64) for k, v in p.items()}
    h = random.normal(0, 0.5, (30, gru.HIDDEN))
    symbols = random.integers(0, 20, 30)
    d_h, grads = gru._output_gradients(p, h, symbols)
    loss = lambda: -gru.log_likelihood(p, h, symbols).sum()
    for array, grad in [(h, d_h), *((p[k], grads[k]) for k in grads)]:
        at = tuple(random.integers(0, s) for s in array.shape)
        old, step = array[at], 1e-5
        array[at] = old + step
        above = loss()
        array[at] = old - step
        below = loss()
        array[at] = old
        assert math.isclose((above - below) / (2 * step), grad[at], rel_tol=1e-3, abs_tol=1e-4)


def test_training_keeps_its_pages():
    import resource

    assert lm_score.keep_freed_memory()
    random = np.random.default_rng(1)
    p = gru.initial(np.ones(128), np.ones((128, 64)))
    docs = [random.integers(0, 128 * 64, 4096 * 20).astype(np.int32)]
    gru.train(p, docs, 1)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
    gru.train(p, docs, 1)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before < 20 * 200  # pages an update


def test_sums_by_symbol():
    random = np.random.default_rng(2)
    symbols, parts = random.integers(0, 9, 50), random.normal(size=(3, 50, 4)).astype(np.float32)
    names, sums = gru._sums_by(symbols, parts)
    assert names.tolist() == np.unique(symbols).tolist()
    for name, total in zip(names, sums):
        assert np.allclose(total, parts[:, symbols == name].sum(axis=1).reshape(-1), atol=1e-5)


def test_state_goes_on_across_windows(monkeypatch):
    random = np.random.default_rng(4)
    p = gru.initial(np.ones(6), np.ones((6, 5)))
    docs = [random.integers(0, 30, n).astype(np.int32) for n in (1, 3, 70, 200, 31, 32, 33)]
    p = gru.train(p, docs, 30)
    whole = []
    for d in docs:
        h = np.zeros((1, gru.HIDDEN), np.float32)
        total = 0.0
        for s in d:
            total += gru.log_likelihood(p, h, np.array([s]))[0]
            h, _ = gru._step(p, np.array([s]), h)
        whole.append(total)
    for lanes in (2, 4096):
        assert np.allclose(gru.score(p, docs, lanes), whole, rtol=1e-4)
    uniform = gru.log_likelihood(p, np.zeros((30, gru.HIDDEN), np.float32), np.arange(30))
    assert math.isclose(np.exp(uniform).sum(), 1, rel_tol=1e-4)


def test_lm_scores(spark, documents, odd, monkeypatch):
    monkeypatch.setattr(lm_score, "HEAD_WORDS", 500)  # most words are joined
    got = {r.doc_id: r for r in QUERIES["op5_lm_score"](spark, DATA).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    words = lambda t: (t or "").encode().lower().split()
    counts, ends = Counter(), 0
    for i, t in texts.items():
        if fold(i) != 1:
            counts.update(words(t))
            ends += 1
    total = sum(counts.values()) + ends
    mass = total + 0.5 * (len(counts) + 2)
    for i, t in texts.items():
        r = got[i]
        base = sum(math.log10((counts[w] + 0.5) / mass) for w in words(t)) + math.log10((ends + 0.5) / mass)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.n_known == sum(counts[w] > 0 for w in words(t)) + 1
        assert (r.n_tokens, r.train_tokens, r.held_out) == (len(words(t)) + 1, total, fold(i) == 1)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    model = lm_score.fit(odd.limit(0))
    rows = lm_score.score_documents(odd, model).collect()
    assert len(rows) == len(ODD) and all(r.n_known == 0 and math.isfinite(r.score) for r in rows)
    assert lm_score.score_documents(odd.limit(0), model).count() == 0


def plain_symbols(vocabulary, text):
    slots, place = lm_score.SLOTS, {w: k for k, w in enumerate(vocabulary.words)}
    out, base, extra, rare = [], 0.0, 0.0, Counter()
    for w in (text or "").encode().lower().split():
        k, c = place.get(w), vocabulary.class_of(w)
        out.append(c * slots + slots - 1 if k is None else int(vocabulary.symbol_of[k]))
        base += 0.0 if k is None else vocabulary.base_of[k]
        extra += -vocabulary.rest_log[c] if k is None else vocabulary.extra_of[k]
        rare.update([w] if k is None else [])
    return [*out, 0], base, extra, rare


def test_words_are_looked_up_without_a_call_each():
    random = np.random.default_rng(5)
    marks = [*" \t\n\r\x0b\x0c", *"\x1c\x85\xa0\u3000\u0130\u00c9\u212a\x00AaZz", "\U0001F600", "the ", "of "]
    texts = ["".join(random.choice(marks, k)) for k in random.integers(0, 12, 400)]
    texts = [None, "", "  ", *texts, "one", None, " ", *(f"word{k} the of" for k in range(3000)), ""]
    counts = Counter(w for t in texts[:300] for w in (t or "").encode().lower().split()).most_common(40)
    vocabulary = lm_score.Vocabulary(
        [w for w, _ in counts], np.array([n for _, n in counts]), {"he": 70.0, "of": 60.0, "a": 50.0}, 90.0, 400, 900.0
    )
    calls = Counter()
    vocabulary.known
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        found = vocabulary.look_up(pa.array(texts))
        sums, others = vocabulary.sums(found), lm_score.other_words(found)
    finally:
        sys.setprofile(None)
    assert calls["call"] + calls["c_call"] < 1000
    symbols = np.split(found.symbols, found.starts[1:])
    for k, text in enumerate(texts):
        want, base, extra, rare = plain_symbols(vocabulary, text)
        assert symbols[k].tolist() == want and others[2][k] == rare.total()
        assert math.isclose(sums[0][k], base, abs_tol=1e-9) and math.isclose(sums[1][k], extra, abs_tol=1e-9)
        assert dict(zip(others[0][k].as_py(), others[1][k].as_py())) == rare
    nothing = lm_score.Vocabulary([], np.zeros(0), {}, 0.0, 0, 0.5)
    assert nothing.look_up(pa.array([None, "a b"])).symbols.tolist() == [0, 127, 127, 0]


def test_text_blocks_keep_every_row():
    texts = [None, "", "a" * 50, "bb", "c" * 9, "d" * 9, None, *["e"] * 40, "f" * 200]
    for rows in (1, 3, 60):
        batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[k:k + rows], pa.string())}) for k in range(0, len(texts), rows)]
        blocks = [b.column("text").to_pylist() for b in lm_score.text_blocks(iter([*batches, batches[0].slice(0, 0)]), 20)]
        assert [t for b in blocks for t in b] == texts
        assert all(len(b) == 1 or sum(len(t or "") + 1 for t in b) <= 20 for b in blocks)
        assert max(map(len, blocks)) == 10


def test_every_training_document_reaches_the_network(spark):
    for text in ("one two three", "a rose is a rose", "four five", "x y z x y z", "last of them"):
        model = lm_score.fit(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))
        masses = model["vocabulary"].slot_mass
        before = gru.initial(masses.sum(axis=1), masses)
        assert not np.array_equal(model["params"]["inputs"], before["inputs"])


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        double = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
        return 13 <= len(digits) <= 19 and (sum(map(int, digits[-1::-2])) + sum(double)) % 10 == 0
    return True


def plain_spans(text):
    return [
        f"{kind}:{m.start()}:{m.end()}" for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "", re.A) if valid(kind, m[0])
    ]


TRICKY = [
    "a@b.c@d.e x_@y.z.com. +1 (377) 555-0271, +12 3", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.0255 1.2.3.4444",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111 79927398713", "é\U0001F600 me@x.io 10.0.0.1",
    "mail a.b@c.d_x@y.zz ++44 20 7946 0958+1 2223334444", "9" * 5000 + " " + "1.2." * 3000 + "a@b" + ".c" * 4000,
]


def test_base_spans(spark, texts):
    rows = [(k, t) for k, t in enumerate([*TRICKY, None, "", *texts.values()])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = pii.find_pii(docs).select("doc_id", pii.spans_text(pii.base_structs()).alias("spans")).collect()
    want = {k: ",".join(plain_spans(t)) for k, t in rows}
    assert {r.doc_id: r.spans for r in got} == want


def test_contexts_discover_unseen_identifiers(spark, odd, tmp_path):
    def card(k):
        for last in range(10):
            if valid("card", f"4000 1234 {k:04d} 567{last}"):
                return f"4000 1234 {k:04d} 567{last}"

    rows = [(k, f"Please charge card number {card(k)} today, ok.") for k in range(30)]
    rows += [(100, "Please charge card number 4000 1234 0001 5679 today, ok. Call 5551234567 x")]
    rows += [(200 + k, f"In the year {1000 + k} we sold 4000 1234 0001 {k:04d} pieces.") for k in range(20)]
    rows += [(300, None), (301, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op8_pii(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    text = rows[30][1]
    at = text.index("4000")
    assert not valid("card", "4000 1234 0001 5679") and got[100].spans == f"card:{at}:{at + 19}"
    for k, t in rows:
        base = ",".join(plain_spans(t))
        assert got[k].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert k == 100 or got[k].spans == base
    assert got[3].n_card == 1 and got[100].n_card == 0
    assert pii.find_pii(odd).count() == len(ODD) and pii.find_pii(odd.limit(0)).count() == 0


def test_identifiers_and_contexts_of_any_length(spark):
    cards = [f"4000 1234 {k:04d} 567{n}" for k in range(6) for n in range(10)]
    seeds = [c for c in cards if valid("card", c)]
    spaced = "4.0-0.0-1.2-3.4-0.0-0.1-5.6-7.9-1.2.3"  # 19 digits, 37 characters
    word = "first." + "x" * 200 + "@" + "long-host" * 20  # an address without a dot after its at sign
    far = " " * 120  # the two words before lie further back than that
    texts = [f"Please charge card number {c} today." for c in seeds]
    texts += [f"Please charge card number {spaced} today."]
    mails = [f"You can write to {n}@mail.example.org about it." for n in ("ann", "bob", "cyd", "dan")]
    texts += [*mails, f"You can write to {word} about it.", f"You can write{far}to{far}zed@host about it."]
    texts += ["9 8 7 6 5 4 3 2 1 " * 400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: [(list(pii.KINDS)[f.kind], texts[r.doc_id][f.start:f.end]) for f in r.found] for r in pii.find_pii(docs).collect()}
    n = len(seeds)
    assert got[n] == [("card", spaced)]
    assert got[n + 5] == [("email", word)] and got[n + 6] == [("email", "zed@host")]
    assert all(not found for k, found in got.items() if k not in (n, n + 5, n + 6))


def test_discovered_identifiers_induce_further_contexts(spark):
    digits = [(f"4000 1234 {k:04d} 567", last) for k in range(12) for last in range(10)]
    good = {d[:14]: d + str(n) for d, n in digits if valid("card", d + str(n))}
    bad = {d[:14]: d + str((int(good[d[:14]][-1]) + 1) % 10) for d, _ in digits}
    seeds, unseen = list(good.values()), list(bad.values())
    texts = [f"Please charge card number {v} today." for v in [*seeds, *unseen[:4]]]
    texts += [f"They said her account {v} was new." for v in unseen[:4]]  # no base match follows
    texts += [f"They said her account {unseen[4]} was new."]
    texts += [f"Then a third code {v} came." for v in unseen[5:9]]  # nothing known follows
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: len(r.found) for r in pii.find_pii(docs).collect()}
    assert got == {k: int(12 <= k < 21) for k in range(len(texts))}


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_contamination(docs, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        for k in range(max(1, len(words) - size + 1) if words else 0):
            windows[tuple(words[k:k + size])].add("" if item is None else str(item))
    out = Counter()
    for i, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if (own := windows.get(tuple(words[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= own
        out[i, len(words), len(hit), ",".join(sorted(found))] += 1
    return out


def test_words_are_split_at_gaps_not_extracted_one_by_one(spark):
    texts = [None, "", "  ", "..a..", "a", "A1 b\u00e9 \u00c9 \u6f22\u5b57, c_d\x7fe\n", "\U0001f600 x[y] \u212a", "\x00a\x85"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    words = rows.select("text", decontaminate.words_of(F.col("text")).alias("words"))
    lowered = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, found in words.collect():
        assert found == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lowered))
    assert "regexp_extract_all" not in words._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("blocks", [20_000, 7])
def test_contamination(spark, documents, texts, odd, monkeypatch, blocks):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", blocks)
    items = [
        (3, "One line. Two lines! THREE lines; four"), (20, "no id"), (3, "no id"), (None, "Text"), (5, None), (6, ""),
        (7, "lorem ipsum dolor " * 5), (8, "ünïcödé"), (9, "not there at all"),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")

    def rows(docs, bench):
        return Counter(
            (r.doc_id, r.n_words, r.n_hit, ",".join(r["items"])) for r in contamination(docs, bench).collect()
        )

    assert rows(odd, bench) == brute_contamination(ODD, items)
    if blocks > 7:
        real = spark.read.parquet(f"{DATA}/benchmark.parquet")
        pairs = [(r.item_id, r.text) for r in real.collect()]
        assert rows(documents, real) == brute_contamination(list(texts.items()), pairs)
    clean = {k for k in brute_contamination(ODD, items) if k[2] == 0}
    kept = drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {k[0] for k in clean}
    assert rows(odd, bench.limit(0)) == brute_contamination(ODD, [])
    assert contamination(odd.limit(0), bench).count() == 0
