"""Every registered query against its SQL on the smallest test set."""

import pytest

import __spark_entry__ as entry
from compare import difference, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert "real_play_count" in entry.entry(spark).columns
