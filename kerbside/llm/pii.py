"""Personal data: fixed patterns, and unseen identifiers by bootstrapped contexts. Built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import saved

KINDS = ("email", "ip", "card", "phone")

# The patterns, each the same as its plain form (in brackets) match for match: a match may begin
# where the last one ended or where a run of its first characters does, as a later place in a run
# fails where its beginning fails; and what can only be taken whole is taken without a way back.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold to match at all: looked for first, in one quick pass.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

# Candidates for unseen identifiers: number groups, or words with a digit or an at sign.
CANDIDATE = (
    r"(?<![0-9A-Za-z])\(?[0-9][0-9().\x20-]++"
    r"|(?<![^\s\"'<(\[])[^\s0-9@\"'<(\[]*+[0-9@][^\s\"'<>()\[\],;]{3,}+"
)
CANDIDATE_NEEDS = "[0-9@]"
TRAILING = ".,:;!?-%*#&$ ()"  # not a candidate's end
# What a candidate must look like to count as one of a kind: weaker than the patterns above.
LOOSE = {
    "email": r"^[^@\s]+@[^@\s]+$",
    "ip": r"^(?:[0-9]+[.:-]){3}[0-9]+$|^(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}$",
    "card": r"^[0-9](?:[\x20.-]?[0-9]){11,18}$",
    "phone": r"^\(?[0-9](?:[().\x20-]{0,3}[0-9]){6,14}$",
}
ROUNDS = 3
LEAST_SEEDS = 3  # different known identifiers a context needs
CONFIDENCE = 0.8


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = _digits(match)
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.when(
        n.between(13, 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0
    ).otherwise(False)


def _small_parts(match: Column) -> Column:
    def small(part: Column) -> Column:
        plain = F.ltrim(part, F.lit("0"))
        return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))

    return F.forall(F.split(match, r"\."), small)


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": _small_parts,
    "card": _luhn,
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}

SPANS = "array<struct<start:int,end:int,value:string,context:string>>"


def _spans(text: Column, pattern: str, valid: Callable, needs: str, trailing: str = "") -> Column:
    """All valid matches with their places and the two words before: ``SPANS``.

    The text between matches and the matches themselves give the places by their lengths. Matches
    that are not valid move the place on but are not kept.
    """
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        match = F.rtrim(pair["match"], F.lit(trailing)) if trailing else pair["match"]
        words = F.regexp_extract(pair["gap"], r"(?<!\S)(\S++\s++\S++)\s*+$", 1)
        span = F.struct(
            start.alias("start"), (start + F.length(match)).alias("end"), match.alias("value"),
            F.lower(F.regexp_replace(words, r"\s+", " ")).alias("context"),
        )
        return F.struct(
            (start + F.length(pair["match"])).alias("at"),
            F.when(valid(match), F.concat(state["kept"], F.array(span)))
            .otherwise(state["kept"]).alias("kept"),
        )

    matched = F.aggregate(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("match")),
        F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("kept")),
        step, lambda state: state["kept"],
    )
    return F.when(text.rlike(needs), matched).otherwise(F.array().cast(SPANS))


def base_spans(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, email, ip, card, phone, candidates)``: one row a document, spans as arrays.

    ``candidates`` are identifier-like places that no base span overlaps.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text",
        *[_spans(F.col("text"), PATTERNS[k], VALID[k], NEEDS[k]).alias(k) for k in KINDS],
    )
    apart = lambda c: ~F.exists(
        F.concat(*KINDS), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])
    )
    possible = lambda m: m.rlike("|".join(f"(?:{p})" for p in LOOSE.values()))
    candidates = _spans(F.col("text"), CANDIDATE, possible, CANDIDATE_NEEDS, TRAILING)
    return saved(
        kinds.select("doc_id", *KINDS, F.filter(candidates, apart).alias("candidates"))
        .withColumn("row", F.monotonically_increasing_id()),
        "base-spans",
    )


def _looks_like(pattern: str) -> Callable[[Column], Column]:
    return lambda candidate: candidate["value"].rlike(pattern)


def occurrences(base: DataFrame) -> DataFrame:
    """``(row, kind, context, value, start, end, known)``: base spans, and candidates by kind."""
    kinds = F.array(*[
        F.struct(F.lit(k).alias("kind"), F.lit(True).alias("known"), F.col(k).alias("spans"))
        for k in KINDS
    ], *[
        F.struct(
            F.lit(k).alias("kind"), F.lit(False).alias("known"),
            F.filter("candidates", _looks_like(LOOSE[k])).alias("spans"),
        )
        for k in KINDS
    ])
    listed = base.select("row", F.explode(kinds).alias("k")).where(F.size("k.spans") > 0)
    return listed.select("row", "k.kind", "k.known", F.explode("k.spans").alias("s")).select(
        "row", "kind", "s.context", "s.value", "s.start", "s.end", "known"
    )


def discovered(base: DataFrame) -> DataFrame:
    """``(row, kind, start, end)``: unseen identifiers by the contexts of known ones.

    The graph has a node for each context (the two words before) and for each identifier, both by
    kind, and an edge where the identifier follows the context. Base spans are the first seeds.
    Contexts are scored from the seeds; identifiers that pass ``CONFIDENCE`` by them are seeds from
    then on, whatever the patterns say, and contexts are scored again until that adds no seed to a
    context that has not passed. In the end, contexts of ``CONFIDENCE`` or more tell what follows.
    """
    every = saved(occurrences(base), "occurrences")
    edges = saved(
        every.where("context <> ''").groupBy("kind", "context", "value").agg(
            F.max("known").alias("known")
        ),
        "edges",
    )
    while True:
        contexts = _scored_contexts(edges)
        sure = contexts.where(F.col("confidence") >= CONFIDENCE).select("kind", "context")
        elsewhere = edges.where(~F.col("known")).join(sure, ["kind", "context"], "left_anti")
        learned = saved(
            _chances(edges, contexts).where(F.col("chance") >= CONFIDENCE)
            .join(elsewhere, ["kind", "value"], "left_semi").select("kind", "value"),
            "learned",
        )
        if learned.isEmpty():
            break
        edges = saved(
            edges.join(learned.withColumn("new", F.lit(True)), ["kind", "value"], "left").select(
                "kind", "context", "value",
                (F.col("known") | F.coalesce("new", F.lit(False))).alias("known"),
            ),
            "edges",
        )
    return every.where(~F.col("known")).join(sure, ["kind", "context"]).select(
        "row", "kind", "start", "end"
    )


def _chances(edges: DataFrame, contexts: DataFrame) -> DataFrame:
    """``(kind, value, chance)``: the chance that at least one context of an identifier is right."""
    chance = F.lit(1.0) - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
    return (
        edges.where(~F.col("known")).join(contexts, ["kind", "context"])
        .groupBy("kind", "value").agg(chance.alias("chance"))
    )


def _scored_contexts(edges: DataFrame) -> DataFrame:
    """``(kind, context, confidence)`` of the contexts that ``LEAST_SEEDS`` different seeds follow.

    A round gives each such context the mean score of the identifiers that follow it: 1 for seeds
    (``known``), and for others their chance by the contexts of the round before.
    """
    contexts = None
    for _ in range(ROUNDS):
        scored = edges.withColumn("score", F.col("known").cast("double"))
        if contexts is not None:
            values = saved(_chances(edges, contexts), "identifiers")
            scored = scored.join(values, ["kind", "value"], "left").withColumn(
                "score", F.when(F.col("known"), 1.0).otherwise(F.coalesce("chance", F.lit(0.0)))
            )
        contexts = saved(
            scored.groupBy("kind", "context").agg(
                F.avg("score").alias("confidence"), F.count_if("known").alias("seeds")
            ).where(F.col("seeds") >= LEAST_SEEDS).select("kind", "context", "confidence"),
            "contexts",
        )
    return contexts


def find_pii(docs: DataFrame) -> DataFrame:
    """``(doc_id, email, ip, card, phone, found)``: one row for each row of ``docs``.

    The first four are arrays of base spans (start, end, value, context), places in code points,
    end exclusive; ``found`` has (kind, start, end) of what the contexts add, which overlaps no base
    span; kind is its place in ``KINDS``. Null is the empty text; repeated rows stay repeated; null
    ids stay null; other columns are not looked at; an empty table gives no rows.
    """
    base = base_spans(docs)
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    added = saved(
        discovered(base).groupBy("row").agg(
            F.array_sort(F.collect_set(F.struct(kind.alias("kind"), "start", "end"))).alias("found")
        ),
        "found-spans",
    )
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return base.drop("candidates").join(added, "row", "left").select(
        "doc_id", *KINDS, F.coalesce("found", none).alias("found")
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of (kind, start, end) structs, by kind, then start, comma-joined."""
    return F.array_join(F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(
            ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1),
            s["start"].cast("string"), s["end"].cast("string"),
        ),
    ), ",")


def base_structs() -> Column:
    """The base spans of all kinds as (kind, start, end)."""
    def named(n: int) -> Callable[[Column], Column]:
        return lambda s: F.struct(
            F.lit(n).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
        )

    return F.concat(*[F.transform(k, named(n)) for n, k in enumerate(KINDS)])
