"""Every registered query against its SQL twin on the given tables."""

import pytest
from oracle import connect, differences

import __spark_entry__ as spark_entry

# Those of the training-data operators are tested in their own folder.
ORACLES = {name: sql for name, sql in spark_entry.oracle_sql().items() if name in spark_entry.QUERIES}
QUERIES = {name: fn for name, fn in spark_entry.queries().items() if name in spark_entry.QUERIES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_all_queries_have_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    # At the smallest scale some reports are rightly empty.
    problem = differences(QUERIES[name](spark, sf_dir), con, ORACLES[name], allow_empty=True)
    assert problem == ""
