"""Language-model scores of whole documents: a gated recurrent model fitted on the training fold."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterator
from functools import cache, cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm import gru
from kerbside.llm.common import saved

# Bounds of what is broadcast: the most frequent words, and the classes and slots of the network.
HEAD_WORDS = 131_072
CLASSES = 128
SLOTS = 64
SUFFIX = 2  # words are classed by so many last characters
# Each training document is in one round, whole: the rounds together pass over all of them once.
ROUNDS = 2
LEAST_UPDATES = 250
COUNTED_BYTES = 32 << 20  # of texts whose words are counted before they are handed on
TEXT_BYTES = 12 << 20  # of texts that are looked up, and scored, side by side
PARAM_BLOCK = 65_536
# Memory a process keeps for its next arrays rather than hand it back, and what is not kept at all.
KEPT_BYTES, LARGE_BYTES = 64 << 20, 16 << 20


@cache
def keep_freed_memory() -> bool:
    """Whether the C library agreed to keep what is freed, up to ``KEPT_BYTES``.

    The network's arrays of some 100 kB to 2 MB come and go thousands of times a task; handed back
    each time, their pages cost more than the arithmetic. The GNU library takes this; others go on
    as they are.
    """
    try:
        mallopt = ctypes.CDLL(None).mallopt
    except (AttributeError, OSError, TypeError):
        return False
    trim, mmap = -1, -3  # the numbers of M_TRIM_THRESHOLD and M_MMAP_THRESHOLD
    return bool(mallopt(trim, KEPT_BYTES) and mallopt(mmap, LARGE_BYTES))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words on end, and how many each text has: A-Z lowered, runs without ASCII white space.

    A null text has none; the end token is not among them.
    """
    plain = pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null("")))
    split = pc.ascii_split_whitespace(plain)
    words, sizes = split.flatten(), np.array(pc.list_value_length(split), np.int64)
    blank = np.asarray(pc.binary_length(plain)) == 0
    if blank.any():  # split to one word of no characters
        words, sizes[blank] = words.filter(pc.not_equal(words, "")), 0
    return words, sizes


def text_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """All rows in order, in blocks of at most ``size`` bytes of ``text``, or of one longer text.

    An end token counts as a byte, so that empty texts do not come without bound.
    """
    held, room = [], size
    for batch in batches:
        lengths = np.asarray(pc.binary_length(batch.column("text")).fill_null(0), np.int64) + 1
        ends, first = np.cumsum(lengths), 0
        while first < len(batch):
            before = int(ends[first] - lengths[first])
            last = int(np.searchsorted(ends, before + room, side="right"))
            if last == first and not held:
                last += 1
            if last > first:
                held.append(batch.slice(first, last - first))
                room -= int(ends[last - 1]) - before
            if last < len(batch):
                yield pa.concat_batches(held)
                held, room = [], size
            first = last
    if held:
        yield pa.concat_batches(held)


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word binary, n)`` over all ``docs``; each task sums before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, COUNTED_BYTES):
            seen = words_of(block.column("text"))[0].value_counts()
            yield pa.RecordBatch.from_arrays(
                [seen.field("values").cast(pa.binary()), seen.field("counts")], names=["word", "n"]
            )

    return docs.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(
        F.sum("n").alias("n")
    )


class Found(NamedTuple):
    """Tokens of texts on end, each text's words and its end token."""

    starts: np.ndarray  # of each text's tokens
    places: np.ndarray  # of each token: a head word's, or that of the end or of any other word
    symbols: np.ndarray
    others: np.ndarray  # the tokens that are other words
    words: pa.DictionaryArray  # and those words


class Vocabulary:
    """From words to symbols. Class 0 is the end token, 1 the words of rare suffixes.

    Slot ``SLOTS - 1`` of a class stands for all its words without a slot of their own.
    """

    def __init__(
        self, words: list[bytes], counts: np.ndarray, suffix_mass: dict[str, float],
        other_mass: float, ends: int, counted: float,
    ):
        """``suffix_mass``: (count + 0.5) of all words by suffix, ``other_mass`` that of the rest."""
        self.class_of_suffix = {s: k + 2 for k, s in enumerate(suffix_mass)}
        self.slot_mass = np.zeros((CLASSES, SLOTS))
        self.slot_mass[0, 0] = ends
        rest = np.zeros(CLASSES)
        rest[1:len(suffix_mass) + 2] = [other_mass, *suffix_mass.values()]
        used = [0] * CLASSES
        symbols = np.zeros(len(words), np.int32)
        for k, (word, n) in enumerate(zip(words, counts.tolist())):
            c = self.class_of(word)
            slot = min(used[c], SLOTS - 1)
            symbols[k] = c * SLOTS + slot
            if slot < SLOTS - 1:
                self.slot_mass[c, slot] = n
                rest[c] -= n + 0.5
                used[c] += 1
        rest[1:] = np.maximum(rest[1:], 0) + 0.5  # half a count for words never seen
        self.slot_mass[1:, SLOTS - 1] = rest[1:]
        self.rest_log = np.log10(np.maximum(rest, 0.5))
        # What each head word adds to the two scores, besides the network's part.
        logs = np.log10(counts + 0.5)
        slotless = symbols % SLOTS == SLOTS - 1
        # The last two entries are those of the end token and of a word that is not in the head.
        self.words = words
        self.symbol_of = np.append(symbols, [0, -1]).astype(np.int32)
        self.base_of = np.append(logs - math.log10(counted), [0.0, 0.0])
        self.extra_of = np.append(
            np.where(slotless, logs - self.rest_log[symbols // SLOTS], 0.0), [0.0, 0.0]
        )

    @cached_property
    def known(self) -> tuple[pa.Array, pa.Array]:
        """Words and suffixes; made where they are used, once for each broadcast."""
        words = pa.array(self.words, pa.binary()).cast(pa.string())
        return words, pa.array(list(self.class_of_suffix), pa.string())

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "known"}

    def class_of(self, word: bytes) -> int:
        return self.class_of_suffix.get(word.decode()[-SUFFIX:], 1)

    def classes_of(self, words: pa.Array) -> np.ndarray:
        suffixes = pc.utf8_slice_codeunits(words, -SUFFIX, None)
        found = pc.index_in(suffixes, value_set=self.known[1].cast(words.type))
        return np.asarray(found.fill_null(-1), np.int64) + 2

    def look_up(self, texts: pa.Array) -> Found:
        words, sizes = words_of(texts)
        starts = np.cumsum(sizes + 1) - sizes - 1
        is_word = np.ones(len(words) + len(texts), bool)
        is_word[starts + sizes] = False
        found = pc.index_in(words, value_set=self.known[0].cast(words.type))
        places = np.full(len(is_word), len(self.words), np.int32)
        places[is_word] = np.asarray(found.fill_null(len(self.words) + 1))
        symbols = self.symbol_of[places]
        others = np.flatnonzero(places == len(self.words) + 1)
        encoded = words.filter(found.is_null()).dictionary_encode()
        classes = self.classes_of(encoded.dictionary)
        symbols[others] = (classes * SLOTS + SLOTS - 1)[np.asarray(encoded.indices)]
        return Found(starts, places, symbols, others, encoded)

    def sums(self, found: Found) -> tuple[np.ndarray, np.ndarray]:
        """What each text's words add to the two scores besides the network's part."""
        extra = self.extra_of[found.places]
        extra[found.others] = -self.rest_log[found.symbols[found.others] // SLOTS]
        return (
            np.add.reduceat(self.base_of[found.places], found.starts),
            np.add.reduceat(extra, found.starts),
        )


def other_words(found: Found) -> tuple[pa.ListArray, pa.ListArray, np.ndarray]:
    """For each text its distinct words that are not in the head, how often, and how many in all."""
    n, distinct = len(found.starts), len(found.words.dictionary)
    text = np.searchsorted(found.starts, found.others, side="right") - 1
    pairs, times = np.unique(text * distinct + np.asarray(found.words.indices), return_counts=True)
    offsets = pa.array(np.searchsorted(pairs, np.arange(n + 1) * distinct), pa.int32())
    words = found.words.dictionary.cast(pa.binary()).take(pa.array(pairs % max(distinct, 1)))
    return (
        pa.ListArray.from_arrays(offsets, words),
        pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
        np.bincount(text, minlength=n),
    )


def head_words(counts: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """At most ``HEAD_WORDS`` words and their counts, by falling count: all above some count.

    A histogram of the counts' logarithms, of bounded size, tells above which.
    """
    step = F.floor(F.log2("n") * 32).cast("int")
    above, least = 0, 2**31 - 1
    for bucket, n in sorted(counts.groupBy(step).count().collect(), reverse=True):
        above += n
        if above > HEAD_WORDS:
            break
        least = bucket
    head = counts.where(step >= least).toArrow()
    n, words = np.asarray(head["n"]), head["word"].to_pylist()
    order = sorted(range(len(words)), key=lambda k: (-n[k], words[k]))
    return [words[k] for k in order], n[order].astype(np.int64)


def suffix_of(word: Column) -> Column:
    return F.right(word.cast("string"), F.lit(SUFFIX))


def fit(docs: DataFrame) -> dict:
    """The model of the training documents: counts of all, network parameters, vocabulary.

    Words are counted over all of ``docs``. The network starts as the counts' unigram model; in each
    round every task trains on its share from the same parameters, and the results are averaged
    block by block in a shuffle. The rounds' shares are disjoint and leave no document out. What is
    gathered grows with the number of tasks, and so with the input; only sums of bounded size reach
    the driver.
    """
    counts = saved(word_counts(docs), "word-counts")
    totals = counts.agg(F.count("*"), F.sum("n")).first()
    ends = docs.count()
    distinct, total = totals[0] + (ends > 0), (totals[1] or 0) + ends
    masses = counts.groupBy(suffix_of(F.col("word")).alias("suffix")).agg(
        F.sum(F.col("n") + 0.5).alias("mass"), F.sum("n").alias("n")
    ).orderBy(F.desc("n"), "suffix").limit(CLASSES - 2)
    suffix_mass = {r["suffix"]: r["mass"] for r in masses.collect()}
    other_mass = (totals[1] or 0) + 0.5 * totals[0] - sum(suffix_mass.values())
    counted = total + 0.5 * (distinct + 1)
    words, head = head_words(counts)
    vocabulary = Vocabulary(words, head, suffix_mass, other_mass, ends, counted)
    params = gru.initial(vocabulary.slot_mass.sum(axis=1), vocabulary.slot_mass)
    model = {"vocabulary": vocabulary, "params": params, "counts": counts,
             "train_tokens": total, "counted": counted, "ends": ends}
    for number in range(ROUNDS):
        model["params"] = _round(docs, model, number)
    return model


def _round(docs: DataFrame, model: dict, number: int) -> gru.Params:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model["vocabulary"], model["params"]))
    shapes = {k: v.shape for k, v in model["params"].items()}

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed_memory()
        vocabulary, start = shared.value
        texts = []
        for block in text_blocks(batches, TEXT_BYTES):
            found = vocabulary.look_up(block.column("text"))
            texts += np.split(found.symbols, found.starts[1:])
        if texts:
            flat = _flat(gru.train(start, texts, LEAST_UPDATES))
            weight = float(sum(map(len, texts)))
            blocks = [flat[k:k + PARAM_BLOCK] for k in range(0, len(flat), PARAM_BLOCK)]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(range(len(blocks)), pa.int32()),
                "weight": pa.array([weight] * len(blocks)),
                "part": pa.array([b.tobytes() for b in blocks], pa.binary()),
            })

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for block, weight, part in zip(*(c.to_pylist() for c in batch.columns)):
                own = sums.setdefault(block, [0.0, 0.0])
                own[0] += weight
                own[1] = own[1] + weight * np.frombuffer(part, np.float32).astype(np.float64)
        for block, (weight, total) in sums.items():
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block], pa.int32()),
                "part": pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary()),
            })

    share = F.pmod(F.xxhash64(F.lit(11), "text"), F.lit(ROUNDS)) == number
    trained = docs.where(share).select("text").mapInArrow(
        learn, "block int, weight double, part binary"
    )
    averaged = trained.repartition("block").mapInArrow(average, "block int, part binary").collect()
    if not averaged:
        return model["params"]
    flat = np.concatenate([
        np.frombuffer(r["part"], np.float32) for r in sorted(averaged, key=lambda r: r["block"])
    ])
    params, at = {}, 0
    for name, shape in shapes.items():
        size = math.prod(shape)
        params[name] = flat[at:at + size].reshape(shape)
        at += size
    return params


def _flat(params: gru.Params) -> np.ndarray:
    return np.concatenate([v.reshape(-1) for v in params.values()])


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)``: one row for each row.

    Scores are log10 probabilities of the whole text and its end token: ``base_score`` under the
    smoothed unigram model, ``score`` under the recurrent model. ``n_known`` counts tokens that
    occur in the training texts. A null or empty text is its end token alone. Repeated rows stay
    repeated, an empty table gives no rows, and with no training text every word is unknown.
    Counts of words beyond the broadcast head are joined by word, whatever their number.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model["vocabulary"], model["params"]))
    log_counted = math.log10(model["counted"])
    end_base = math.log10(model["ends"] + 0.5) - log_counted
    end_known = int(model["ends"] > 0)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed_memory()
        vocabulary, params = shared.value
        for block in text_blocks(batches, TEXT_BYTES):
            found = vocabulary.look_up(block.column("text"))
            base, extra = vocabulary.sums(found)
            words, times, n_rare = other_words(found)
            sizes = np.diff(np.append(found.starts, len(found.symbols)))
            network = gru.score(params, np.split(found.symbols, found.starts[1:])) / math.log(10)
            yield pa.RecordBatch.from_arrays([
                block.column("doc_id"), pa.array(sizes), pa.array(sizes - 1 - n_rare + end_known),
                pa.array(base + end_base - n_rare * log_counted), pa.array(network + extra),
                words, times,
            ], names=["doc_id", "n_tokens", "n_known", "base", "score", "words", "times"])

    id_type = pa.int64() if docs.schema["doc_id"].dataType.typeName() == "long" else pa.string()
    ids = F.col("doc_id") if id_type == pa.int64() else F.col("doc_id").cast("string").alias("doc_id")
    scored = saved(
        docs.select(ids, "text").mapInArrow(
            compute,
            f"doc_id {'bigint' if id_type == pa.int64() else 'string'}, n_tokens bigint, "
            "n_known bigint, base double, score double, words array<binary>, times array<bigint>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    rare = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times")
    )
    counts = model["counts"].withColumnRenamed("n", "count")
    added = saved(
        rare.join(counts, "word", "left").groupBy("row").agg(
            F.sum(F.when(F.col("count") > 0, F.col("times")).otherwise(0)).alias("known"),
            F.sum(F.col("times") * F.log10(F.coalesce("count", F.lit(0)) + F.lit(0.5))).alias("logs"),
        ),
        "rare-words",
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.drop("words", "times").join(added, "row", "left").select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model["train_tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"), (F.col("score") + logs).alias("score"),
    )

