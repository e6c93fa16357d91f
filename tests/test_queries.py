"""Every registered query against its SQL on the smallest tables, with and without broadcasts."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from compare import differences
from kerbside.registry.oracles import ORACLES
from kerbside.registry.queries import QUERIES

DATA = "/root/testdata/sf0.001"

# Queries whose joins Spark would all broadcast at this size.
JOINING = [
    "monthly_zone_revenue", "stg_green", "fact_trips", "fact_fhv_trips", "popular_destination",
    "priciest_route", "top_pairs", "dq_relationships", "dq_report", "csv_row_index",
]


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert ORACLES.keys() <= entry_module.oracle_sql().keys()


def test_entry_is_the_flagship(spark):
    assert len(entry_module.entry(spark).columns) == 13


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, DATA), DATA, ORACLES[name]) == []


@pytest.mark.parametrize("name", JOINING)
def test_query_equals_sql_when_tables_are_too_large_to_broadcast(spark, name, monkeypatch):
    monkeypatch.setattr("kerbside.operators.lookups.BROADCAST_BYTES", 0)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        df = QUERIES[name](spark, DATA)
        assert differences(df, DATA, ORACLES[name]) == []
    finally:
        spark.conf.set(threshold, before)
