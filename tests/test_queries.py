"""Every registered query against its SQL on the small tables."""

import os

import pytest

from kpitide.plans import QUERIES
from tests.compare import DATA, connect, differences

SF_DIR = str(DATA / os.environ.get("TEST_SF", "sf0.001"))


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    query = QUERIES[name]
    df = query.run(spark, SF_DIR)
    assert differences(df, query.sql, con) == []
    assert df.count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() > 0
