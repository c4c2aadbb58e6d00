"""Every registered query against its DuckDB SQL on the smallest tables, and the entry point."""

import pytest

import __spark_entry__ as entry
from conftest import SF001
from oracle import compare, duck
from sluice.plans.registered import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SF001, con)
    assert ok, msg


def test_every_query_of_the_operators_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["event_id", "id", "name", "effective_date", "city"]
