"""Every registered query against its DuckDB statement on the same files."""

import pytest

import __spark_entry__
from compare import connect, differences

from tallymark.catalog import registry  # noqa: E402

QUERIES = registry.QUERIES  # those of the llm subpackage have tests of their own
ORACLES = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folder, connection, name):
    df = QUERIES[name](spark, folder)
    if name not in ORACLES:
        assert df.count() > 0
        return
    problem, rows = differences(df, connection, ORACLES[name])
    assert problem is None
    assert rows > 0


def test_every_query_of_the_library_has_a_statement():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert {r.country_code for r in rows} == {"GB", "FR", "IT", "NL"}
