"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from tests import oracle

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()

# Empty on the smallest data set; the larger ones have rows.
MAY_BE_EMPTY = {"duplicate_incident_plan"}


@pytest.fixture(scope="module")
def duck(data):
    return oracle.connect(data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, duck, name):
    difference = oracle.compare(spark, duck, data, QUERIES[name], ORACLES[name])
    if name in MAY_BE_EMPTY and difference == "both sides are empty":
        return
    assert difference is None, difference


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_twin_has_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    frame = entry_point.entry(spark)
    assert frame.columns[:2] == ["race_id", "car_id"]
    assert frame.count() > 0
