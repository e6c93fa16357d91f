"""Language identification by cross-parsing against suffix automata of labelled text."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import whole_rows

# Bounds of the labelled sample the automata are built from: symbols over all languages together,
# and the most one document adds (from its middle). Counting and predicting cover everything.
SAMPLE_SYMBOLS = 160_000
SAMPLE_DOC_CHARS = 4_000
SAMPLE_SPARE = 3
DENSE_ENTRIES = 16_000_000  # of an automaton's table; larger ones list the ways they have
WINDOW = 512  # symbols parsed in one go; a phrase ends with its window
LANES = 4_096
UNKNOWN = "und"


class LanguageModel:
    """One suffix automaton a language, as a table from (state, symbol) to state.

    Each language has an alphabet of its own, all letters of its sample; a letter outside it is a
    phrase by itself there.
    """

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        self.letters = "".join(sorted({c for t in samples.values() for c in t.lower() if c.isalpha()}))
        self.tables, self.cost, self.own = [], [], []
        for lang in self.langs:
            symbols = self.symbols(samples[lang])
            alphabet = np.unique(symbols[symbols > 0])
            own = np.full(len(self.letters) + 2, len(alphabet) + 1, np.int32)
            own[0] = 0
            own[alphabet] = np.arange(1, len(alphabet) + 1)
            self.own.append(own)
            self.tables.append(suffix_automaton(own[symbols].tolist(), len(alphabet) + 2))
            self.cost.append(np.log2(max(2, len(symbols))))

    def symbols(self, text: str) -> np.ndarray:
        """Lowered letters as 1, 2, ...; runs of anything else as one 0."""
        points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
        codes = _code_table(self.letters)[points]
        keep = codes > 0
        keep[1:] |= codes[:-1] > 0
        return codes[keep]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """``[language, text]``: phrases in the greedy parse of each text, window by window."""
        owner = np.repeat(
            np.arange(len(texts)), [-(-len(t) // WINDOW) for t in texts]
        )
        pieces = [t[s:s + WINDOW] for t in texts for s in range(0, len(t), WINDOW)]
        counts = np.zeros((len(self.langs), len(texts)), np.int64)
        order = np.argsort([-len(p) for p in pieces], kind="stable")
        for start in range(0, len(order), LANES):
            lanes = order[start:start + LANES]
            sizes = np.array([len(pieces[k]) for k in lanes])
            grid = np.zeros((len(lanes), sizes[0]), np.int32)
            for row, k in enumerate(lanes):
                grid[row, :sizes[row]] = pieces[k]
            grid = np.ascontiguousarray(grid.T)
            active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
            for lang, (table, own) in enumerate(zip(self.tables, self.own)):
                np.add.at(counts[lang], owner[lanes], _parse(table, own.take(grid), active))
        return counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and confidence of each text; phrases are normalised by what naming one costs."""
        symbols = [self.symbols(t) if t else np.zeros(0, np.int32) for t in texts]
        none = np.array([not s.any() for s in symbols], bool)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        rates = self.phrases(symbols) * np.array(self.cost)[:, None]
        best = rates.argmin(axis=0)
        least = rates[best, np.arange(len(texts))]
        if len(self.langs) > 1:
            second = np.partition(rates, 1, axis=0)[1]
            score = np.where(second > 0, 1 - least / np.maximum(second, 1e-9), 0.0)
        else:
            score = np.ones(len(texts))
        langs = [UNKNOWN if n else self.langs[b] for n, b in zip(none, best)]
        return langs, np.where(none, 0.0, score)


@cache
def _code_table(letters: str) -> np.ndarray:
    table = np.zeros(0x110000, np.int32)
    for point in range(len(table)):
        if chr(point).isalpha():
            table[point] = len(letters) + 1
    for k, letter in enumerate(letters):
        table[ord(letter)] = k + 1
    return table


class _Ways:
    """The entries of a table that are not -1; taken like a table's."""

    def __init__(self, entries: dict[int, int]):
        self.places = np.array(sorted(entries), np.int64)
        self.values = np.array([entries[p] for p in self.places.tolist()], np.int64)

    def take(self, places: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return np.where(self.places[at] == places, self.values[at], -1)


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray | _Ways:
    """States of the automaton of all substrings; entry ``state + symbol`` is the next state.

    States are named by the place of their row, the start is 0, and -1 is no way on.
    """
    nexts: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in symbols:
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in nexts[at]:
            nexts[at][symbol] = new
            at = link[at]
        if at >= 0:
            target = nexts[at][symbol]
            if length[at] + 1 == length[target]:
                link[new] = target
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and nexts[at].get(symbol) == target:
                    nexts[at][symbol] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    if len(nexts) * width > DENSE_ENTRIES:
        return _Ways({
            state * width + symbol: target * width
            for state, ways in enumerate(nexts) for symbol, target in ways.items()
        })
    table = np.full((len(nexts), width), -1, np.int32)
    for state, ways in enumerate(nexts):
        for symbol, target in ways.items():
            table[state, symbol] = target * width
    return table.reshape(-1)


def _parse(table: np.ndarray | _Ways, grid: np.ndarray, active: np.ndarray) -> np.ndarray:
    """Phrases of each lane: the longest match each time; a symbol never seen is one phrase."""
    state = np.zeros(grid.shape[1], np.int32 if isinstance(table, np.ndarray) else np.int64)
    count = np.zeros(grid.shape[1], np.int64)
    fresh = np.maximum(table.take(np.arange(int(grid.max(initial=0)) + 1)), 0)  # from the start
    for row, n in zip(grid, active):
        symbol, now = row[:n], state[:n]
        onward = table.take(now + symbol)
        stuck = onward < 0
        count[:n] += stuck | (now == 0)
        state[:n] = np.where(stuck, fresh.take(symbol), onward)
    return count


def labelled_sample(docs: DataFrame, label: str = "lang", text: str = "text") -> dict[str, str]:
    """A bounded sample of each label's texts, joined: rows of least text hash, the middle of each.

    All labelled texts are counted first, copies once; the share of hashes to look at follows from
    the count, so what reaches the driver is bounded by ``SAMPLE_SYMBOLS`` however large the table
    is, and a text with many copies takes nothing from the others of its label.
    """
    piece = F.least(F.length(text), F.lit(SAMPLE_DOC_CHARS))
    rows = docs.where(F.col(label).isNotNull() & (F.length(text) > 0))
    place = F.xxhash64(F.lit(7), F.col(text)).bitwiseAND(F.lit((1 << 63) - 1))
    texts = rows.groupBy(F.col(label).alias("label"), place.alias("place")).agg(F.max(piece).alias("n"))
    chars = {r[0]: r[1] for r in texts.groupBy("label").agg(F.sum("n")).collect()}
    if not chars:
        return {}
    each = max(1, SAMPLE_SYMBOLS // len(chars))
    share = F.create_map(*[
        x for name, n in chars.items()
        for x in (F.lit(name), F.lit(int(min(1.0, SAMPLE_SPARE * max(each, 4 * SAMPLE_DOC_CHARS) / n) * (2**63 - 2**10))))
    ])
    middle = F.greatest(F.lit(1), F.floor((F.length(text) - SAMPLE_DOC_CHARS) / 2) + 1).cast("int")
    chosen = rows.where(place <= share[F.col(label)]).select(
        F.col(label), place.alias("place"),
        F.substring(F.col(text), middle, F.lit(SAMPLE_DOC_CHARS)).alias("piece"),
    ).distinct().orderBy(label, "place").collect()
    samples: dict[str, str] = {}
    for lang, _, excerpt in chosen:
        have = samples.get(lang, "")
        if len(have) < each:
            samples[lang] = f"{have} {excerpt}"[:each]
    return samples


def fit(docs: DataFrame, label: str = "lang", text: str = "text") -> LanguageModel:
    """A model from the labelled rows of ``docs``; without any, it knows no language."""
    return LanguageModel(labelled_sample(docs, label, text))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``(row, lang_pred, score)``: each row of ``docs``, whole, and the language of its whole text.

    ``und`` with score 0 for null, empty and letterless texts and if the model knows no language.
    Equal counts go to the first language in order. The score is how far the next language lies
    behind (0: as near, towards 1: far). Repeated rows stay repeated.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    given = docs.select(whole_rows(docs).alias("row"))  # the text goes to Python once, as its field
    names = docs.columns
    place = names.index(text) if text in names else [n.lower() for n in names].index(text.lower())
    schema = T.StructType([
        given.schema["row"], T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 1_000):
                batch = whole.slice(start, 1_000)
                texts = batch.column(0).field(place)
                langs, score = shared.value.predict(texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(langs, pa.string()), pa.array(score)],
                    names=schema.names,
                )

    return given.mapInArrow(predict, schema)
