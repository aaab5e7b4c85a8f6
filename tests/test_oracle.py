"""Every registered query against its DuckDB oracle (the driver's check)."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck_connect
from tripwise.plans import catalog

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_connect(sf_dir)


def test_every_travel_query_has_an_oracle():
    """The optional subpackage names its queries without SQL in its own tests."""
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "VISIT_COUNT" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, con, name):
    ok, msg = compare(QUERIES[name](spark, sf_dir), ORACLE[name], con)
    assert ok, msg
