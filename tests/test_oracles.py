"""Every registered query against DuckDB on the driver's smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


# The training-data queries have tests of their own.
@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    assert name in entry.oracle_sql()
    assert oracle.compare(df, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["prompt_id", "chosen", "rejected", "source"]
