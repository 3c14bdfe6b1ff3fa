"""Every query with a SQL counterpart, on the smallest data folder."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from tools.check import differences, open_database

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
# Known limit: of 160 trips the perceptron learns nothing (0.53 of 40 held-out trips right); of 1,582 it does (0.97).
TOO_FEW_TRIPS = {"train_on_rule"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def database():
    return open_database(FOLDER)


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def _marked(name):
    if name in TOO_FEW_TRIPS:
        return pytest.param(name, marks=pytest.mark.xfail(reason="160 trips are too few for the perceptron", strict=False))
    return name


@pytest.mark.parametrize("name", [_marked(name) for name in sorted(entry_points.oracle_sql())])
def test_query_equals_sql(spark, database, name):
    rows, found = differences(entry_points.queries()[name](spark, FOLDER), database, entry_points.oracle_sql()[name])
    assert not found
    assert rows > 0


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test data")
@pytest.mark.parametrize("name", sorted(TOO_FEW_TRIPS))
def test_query_equals_sql_over_more_trips(spark, name):
    rows, found = differences(entry_points.queries()[name](spark, LARGER), open_database(LARGER), entry_points.oracle_sql()[name])
    assert not found
    assert rows > 0
