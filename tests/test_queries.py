"""Every registered query agrees with its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.check_queries import compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    assert compare(spark, duck, name, SMALL) is None


def test_entry_is_the_flagship(spark):
    assert entry.entry(spark).columns == ["event_day", "quarantine_reason", "records"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
