from __future__ import annotations

import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbside.operators import aggregates, inspect, topn, unions
from kerbside.operators.dedup import first_per_key
from kerbside.operators.lookups import Lookup, join_role, key_as, measured_bytes, orphan_keys
from kerbside.operators.quality import (
    Check, DataCheckError, check_model, enforce, load_audit, missing_values, observed_rows,
    repeated_values, unaccepted_values, unmatched_values,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


cell = st.one_of(st.none(), st.integers(0, 2))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(cell, cell, cell, st.one_of(st.none(), st.text("ab", max_size=2)))))
def test_first_per_key_is_the_least_row_of_each_key(spark, data):
    df = spark.createDataFrame(data, "k int, j int, v int, s string")
    best = {}
    for row in data:
        rank = tuple((x is not None, x if x is not None else 0) for x in row[2:])
        if row[:2] not in best or rank < best[row[:2]][0]:
            best[row[:2]] = (rank, row)
    assert rows(first_per_key(df, ["k", "j"])) == sorted((b[1] for b in best.values()), key=str)


def test_first_per_key_edges(spark):
    data = [(1, 1), (1, 1), (1, None), (None, None), (None, None)]
    df = spark.createDataFrame(data, "k int, v int")
    assert rows(first_per_key(df, ["K"])) == [(1, None), (None, None)]
    assert rows(first_per_key(df, ["k", "v"])) == [(1, 1), (1, None), (None, None)]


def test_unions(spark):
    green = spark.createDataFrame([(1, "a", 2.0)], "id int, Name string, fee double")
    yellow = spark.createDataFrame([(5, "z", 3)], "extra int, Name string, id int")
    assert unions.common_columns(green, yellow) == ["id", "Name"]
    # Names compare case-sensitively.
    assert unions.common_columns(green, yellow.withColumnRenamed("Name", "name")) == ["id"]
    tagged = unions.union_tagged({"g": green, "y": yellow}, "tag")
    assert tagged.columns == ["id", "Name", "tag"]
    assert rows(tagged) == [(1, "a", "g"), (3, "z", "y")]
    with pytest.raises(ValueError, match="columns differ"):
        unions.union_same_shape(green, green.select("Name", "id", "fee"))
    assert unions.union_same_shape(green, green).count() == 2


def test_join_role_across_key_types(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "id int")
    text = spark.createDataFrame(
        [("1", "one"), ("2.5", "half"), ("x", "bad"), (None, "none")], "key string, name string"
    )
    for lookup in (Lookup(text, True), Lookup(text, False)):
        joined = join_role(facts, lookup, "id", "key", {"name": "label"})
        assert joined.columns == ["id", "label"]
        assert rows(joined) == [(1, "one"), (1, "one")]
    exact = text.filter("name <> 'bad'").withColumn("key", F.col("key").cast("decimal(38,9)"))
    assert rows(join_role(facts, Lookup(exact, True), "id", "key", {})) == [(1,), (1,)]


def test_a_lossy_key_matches_nothing(spark):
    df = spark.createDataFrame([("7",), ("7.5",), ("7.0",), ("99999999999",)], "k string")
    got = df.select(key_as(F.col("k"), df.select(F.lit(1)).schema[0].dataType)).collect()
    assert [r[0] for r in got][:2] == [7, None] and got[3][0] is None


def test_lookup_is_measured(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 10, "s string")
    assert 10_000 <= measured_bytes(df) <= 11_000
    assert Lookup.measure(df).small and not Lookup.measure(df, max_bytes=9_999).small
    assert measured_bytes(df.filter("false")) == 0
    plan = Lookup(df, False).side(F.col("s"))._jdf.queryExecution().toString()
    assert "broadcast" not in plan.lower()


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    parent = spark.createDataFrame([("1",), ("3",)], "key string")
    assert rows(orphan_keys(child, "id", Lookup(parent, True), "key")) == [(2, 2)]
    named = unmatched_values(child, "id", Lookup(parent, False), "key")
    assert named.columns == ["id", "n"] and rows(named) == [(2, 2)]


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", None)], "k string, v double")
    got = df.groupBy("k").agg(
        aggregates.exact_sum(df, "v").alias("s"), aggregates.exact_avg(df, "v").alias("a")
    )
    assert rows(got) == [("a", 0.3, 0.15), ("b", None, None)]
    assert rows(aggregates.count_by(df, "k")) == [("a", 2), ("b", 1)]
    assert rows(aggregates.row_count(df)) == [(3,)]
    assert rows(aggregates.distinct_count(df, "v")) == [(2,)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10**8, 10**8), min_size=1, max_size=60))
def test_sums_of_cents_do_not_depend_on_order(spark, cents):
    amounts = [(c / 100,) for c in cents]
    for data in (amounts, amounts[::-1]):
        df = spark.createDataFrame(data, "v double")
        assert df.agg(aggregates.exact_sum(df, "v")).first()[0] == sum(cents) / 100


def test_sums_of_infinite_and_very_large_values(spark):
    for values in ([1.0, math.inf], [1e305], [1e305, -1e305, 2.5], [None], [None, 1.5], [-math.inf]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        got = df.agg(aggregates.exact_sum(df, "v"), F.sum("v")).first()
        assert got[0] == got[1]


def test_sums_keep_finer_values(spark):
    values = [0.00001, 0.123456, -7.000004, 1e12, 2.5e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    total = df.filter("v < 1e6").agg(aggregates.exact_sum(df, "v")).first()[0]
    assert abs(total - math.fsum(v for v in values if v < 1e6)) < 1e-12
    assert df.agg(aggregates.exact_sum(df, "v")).first()[0] == pytest.approx(math.fsum(values))


def test_top_rows_and_samples(spark):
    df = spark.createDataFrame([(None, "n"), (5, "b"), (5, "a"), (1, "c")], "v int, s string")
    assert [tuple(r) for r in topn.top_rows(df, "v", 2).collect()] == [(5, "a"), (5, "b")]
    assert topn.top_rows(df, "v", 9).collect()[-1].v is None
    assert topn.dev_sample(df, on=False, rows=1).count() == 4
    assert topn.dev_sample(df, on=True, rows=1).count() == 1
    assert len(topn.preview(df, 3).collect()) == 3


def test_schema_as_rows_and_ddl(spark):
    df = spark.createDataFrame([(1, "a")], "id int not null, name string")
    assert inspect.schema_rows(df) == [(0, "id", "int", False), (1, "name", "string", True)]
    assert inspect.table_ddl(df, "t") == "CREATE TABLE t (id INT NOT NULL,name STRING)"
    assert inspect.table_ddl(df, "lake.my trips`2021").startswith("CREATE TABLE lake.`my trips``2021` (id")


MODEL = [
    ("a", 1, 1), ("a", 2, 7), ("b", 9, 7), (None, None, None), (None, 9, 3), ("c", 9, 8),
]


def test_single_checks(spark):
    df = spark.createDataFrame(MODEL, "id string, zone int, pay int")
    assert rows(repeated_values(df, "id")) == [("a", 2)]
    assert missing_values(df, "id").count() == 2
    assert rows(unaccepted_values(df, "pay", [1, 2, 3])) == [(7, 2), (8, 1)]


@pytest.mark.parametrize("small", [True, False])
def test_report_equals_the_single_checks(spark, small):
    df = spark.createDataFrame(MODEL, "id string, zone int, pay int")
    keys = spark.createDataFrame([(1,), (2,), (2,)], "key int")
    zones = Lookup(keys.select(F.col("key").cast("decimal(38,9)").alias("key")), small)
    checks = [
        Check("unique", "id", "warn"),
        Check("not_null", "id"),
        Check("relationships", "zone"),
        Check("relationships", "pay", "warn"),
        Check("accepted_values", "pay", "warn", (1, 2, 3)),
    ]
    report = check_model("m", df, checks, zones, "key")
    assert rows(report) == sorted([
        ("m", "id", "unique", "warn", 1),
        ("m", "id", "not_null", "error", 2),
        ("m", "zone", "relationships", "error", 3),
        ("m", "pay", "relationships", "warn", 4),
        ("m", "pay", "accepted_values", "warn", 3),
    ], key=str)
    with pytest.raises(DataCheckError, match="m.id not_null: 2; m.zone relationships: 3"):
        enforce(report.orderBy("column"))
    assert len(enforce(report.filter("severity = 'warn'"))) == 3


def test_report_without_foreign_keys_or_rows(spark):
    df = spark.createDataFrame([], "id string, pay decimal(38,9)")
    checks = [Check("unique", "id"), Check("accepted_values", "pay", "error", (1,))]
    nothing = Lookup(spark.createDataFrame([], "key int"), True)
    assert [r.failing_rows for r in check_model("m", df, checks, nothing, "key").collect()] == [0, 0]
    some = spark.createDataFrame([("x", 1), ("y", 2)], "id string, pay int").withColumn(
        "pay", F.col("pay").cast("decimal(38,9)")
    )
    got = check_model("m", some, checks, nothing, "key").collect()
    assert Counter(r.failing_rows for r in got) == {0: 1, 1: 1}
    with pytest.raises(ValueError, match="unknown check"):
        check_model("m", df, [Check("odd", "id")], nothing, "key")


def test_audit(spark):
    want = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "m string")
    have = spark.createDataFrame([("1",), (None,), ("3",)], "m string")
    assert rows(load_audit(want, have, "m")) == sorted(
        [("1", 2, 1, 50.0), ("2", 1, 0, 0.0), ("3", 0, 1, None), (None, 1, 1, 100.0)], key=str
    )
    counted, counter = observed_rows(want)
    counted.write.format("noop").mode("overwrite").save()
    assert counter.get == {"rows": 4}
