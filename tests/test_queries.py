from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from headway import oracle
from headway.queries import QUERIES
from tests.compare import assert_same_rows, connect, expected

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    """The rows of all queries, several at a time, as most of each is planning."""

    def run(name):
        df = QUERIES[name](spark, SF_DIR)
        return df.schema, df.collect()

    # The landed tables are shared, so they are there before.
    run("landed_errors")
    with ThreadPoolExecutor(6) as pool:
        return {name: pool.submit(run, name) for name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(results, duck, name):
    schema, rows = results[name].result()
    assert_same_rows(schema, rows, *expected(duck, oracle.oracle_sql()[name]))


def test_every_query_has_sql():
    assert QUERIES.keys() == oracle.oracle_sql().keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
