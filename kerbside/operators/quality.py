"""Declared data checks: unique, not-null, foreign key, accepted values."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kerbside.operators.lookups import Lookup, key_as, orphan_keys

log = logging.getLogger(__name__)


# --- single checks: each returns the failing values ---------------------------

def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is not a value."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.filter("n > 1")


def missing_values(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted_values(df: DataFrame, column: str, accepted: Iterable) -> DataFrame:
    """Values outside the list, with their row counts; NULL passes."""
    bad = df.filter(~F.col(column).isin(list(accepted)))
    return bad.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def unmatched_values(df: DataFrame, column: str, parent: Lookup, parent_key: str) -> DataFrame:
    return orphan_keys(df, column, parent, parent_key).withColumnRenamed("child_key", column)


# --- all checks of a model in one pass ----------------------------------------

@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    severity: str = "error"
    accepted: tuple = field(default=())


KINDS = ("unique", "not_null", "relationships", "accepted_values")


def check_model(
    model: str, df: DataFrame, checks: list[Check], parent: Lookup, parent_key: str
) -> DataFrame:
    """Failing rows per check, as (model, column, check, severity, failing_rows).

    The model is evaluated once. With one unique column and a parent small enough to broadcast, the
    other checks are flags on the row, and one record for each of its keys is shuffled. Otherwise
    every checked column contributes its (column, value) pairs to a single count. Both combine
    before the shuffle, so a value holding a third of the rows costs one row per task.
    """
    for check in checks:
        if check.kind not in KINDS:
            raise ValueError(f"unknown check {check.kind}")
    keys = {c.column for c in checks if c.kind == "unique"}
    if len(keys) == 1 and parent.small:
        totals = _totals_by_key(df, checks, parent, parent_key, keys.pop())
    else:
        totals = _totals_by_value(df, checks, parent, parent_key)
    report = F.explode(
        F.array(*[
            F.struct(
                F.lit(model).alias("model"),
                F.lit(c.column).alias("column"),
                F.lit(c.kind).alias("check"),
                F.lit(c.severity).alias("severity"),
                F.col(f"check_{i}").alias("failing_rows"),
            )
            for i, c in enumerate(checks)
        ])
    )
    return totals.select(report.alias("r")).select("r.*")


def _totals_by_key(
    df: DataFrame, checks: list[Check], parent: Lookup, parent_key: str, key: str
) -> DataFrame:
    """One row, ``check_0, check_1, ...``: failing rows, by way of one record for each key."""
    frame = df.select(*sorted({c.column for c in checks}))
    for column in sorted({c.column for c in checks if c.kind == "relationships"}):
        known = key_as(F.col(parent_key), df.schema[column].dataType)
        parents = parent.frame.select(known.alias("parent")).distinct()
        frame = frame.join(
            F.broadcast(parents), F.col(column) == F.col("parent"), "left"
        ).withColumnRenamed("parent", f"parent of {column}")

    def failing(check: Check) -> Column:
        value = F.col(check.column)
        match check.kind:
            case "not_null":
                return value.isNull()
            case "relationships":
                return value.isNotNull() & F.col(f"parent of {check.column}").isNull()
            case "accepted_values":
                return ~value.cast("string").isin(_accepted_texts(check, df))
            case _:
                return F.lit(False)  # counted from the keys

    per_key = frame.groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(failing(c)).alias(f"check_{i}") for i, c in enumerate(checks)],
    )
    repeated = F.count_if(F.col("key").isNotNull() & (F.col("n") > 1))
    return per_key.agg(*[
        (repeated if c.kind == "unique" else F.coalesce(F.sum(f"check_{i}"), F.lit(0).cast("bigint")))
        .alias(f"check_{i}")
        for i, c in enumerate(checks)
    ])


def _accepted_texts(check: Check, df: DataFrame) -> list[Column]:
    """The accepted values as the column's own type would print them."""
    kind = df.schema[check.column].dataType
    return [F.lit(v).cast(kind).cast("string") for v in check.accepted]


def _totals_by_value(
    df: DataFrame, checks: list[Check], parent: Lookup, parent_key: str
) -> DataFrame:
    """The same by way of one record for each value of each column."""
    columns = sorted({c.column for c in checks})
    pairs = F.explode(
        F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ])
    )
    counts = (
        df.select(pairs.alias("pair"))
        .groupBy(F.col("pair.column").alias("column"), F.col("pair.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )

    linked = sorted({c.column for c in checks if c.kind == "relationships"})
    if linked:
        # The parent's keys as each child column would print them.
        keys = F.explode(
            F.array(*[
                F.struct(
                    F.lit(c).alias("column"),
                    key_as(F.col(parent_key), df.schema[c].dataType).cast("string").alias("value"),
                )
                for c in linked
            ])
        )
        parents = (
            parent.frame.select(keys.alias("key")).select("key.*").distinct()
            .withColumn("has_parent", F.lit(True))
        )
        counts = counts.join(
            F.broadcast(parents) if parent.small else parents, ["column", "value"], "left"
        )
    else:
        counts = counts.withColumn("has_parent", F.lit(None).cast("boolean"))

    return counts.agg(*[
        _failing(c, df).alias(f"check_{i}") for i, c in enumerate(checks)
    ])


def _failing(check: Check, df: DataFrame) -> Column:
    here = F.col("column") == check.column
    present = F.col("value").isNotNull()
    n = F.col("n")
    match check.kind:
        case "unique":
            failing = F.when(here & present & (n > 1), F.lit(1))
        case "not_null":
            failing = F.when(here & ~present, n)
        case "relationships":
            failing = F.when(here & present & F.col("has_parent").isNull(), n)
        case _:
            listed = F.col("value").isin(_accepted_texts(check, df))
            failing = F.when(here & present & ~listed, n)
    return F.coalesce(F.sum(failing.cast("bigint")), F.lit(0).cast("bigint"))


class DataCheckError(Exception):
    """A check of severity ``error`` found failing rows."""


def enforce(report: DataFrame) -> list:
    """Log warnings and raise on errors. The report has one row per declared check."""
    failed = report.filter("failing_rows > 0").collect()
    for row in failed:
        log.warning("%s.%s %s: %d failing", row.model, row.column, row.check, row.failing_rows)
    errors = [r for r in failed if r.severity == "error"]
    if errors:
        raise DataCheckError(
            "; ".join(f"{r.model}.{r.column} {r.check}: {r.failing_rows}" for r in errors)
        )
    return failed


# --- load audit -----------------------------------------------------------------

def observed_rows(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame plus a counter filled by whatever action writes it, at no extra pass."""
    counter = Observation()
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def load_audit(expected: DataFrame, loaded: DataFrame, by: str) -> DataFrame:
    """Rows expected and loaded per ``by`` value, and the share done in percent."""
    want = expected.groupBy(by).agg(F.count(F.lit(1)).alias("expected_rows"))
    have = loaded.groupBy(by).agg(F.count(F.lit(1)).alias("loaded_rows"))
    joined = want.join(have, want[by].eqNullSafe(have[by]), "full_outer")
    expected_rows = F.coalesce("expected_rows", F.lit(0).cast("bigint"))
    loaded_rows = F.coalesce("loaded_rows", F.lit(0).cast("bigint"))
    return joined.select(
        F.coalesce(want[by], have[by]).alias(by),
        expected_rows.alias("expected_rows"),
        loaded_rows.alias("loaded_rows"),
        F.try_divide(loaded_rows * 100.0, expected_rows).alias("percent_done"),
    )
