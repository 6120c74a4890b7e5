"""Every registered query against its SQL, over the whole small tables."""

import pytest
from conftest import SMALL

import __spark_entry__ as entry
from check import database, rows_of_frame, rows_of_sql
from ticketloom.plans.catalog import QUERIES
from ticketloom.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert rows_of_frame(entry.queries()[name](spark, SMALL)) == rows_of_sql(con, entry.oracle_sql()[name])
