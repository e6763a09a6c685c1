"""Every registered query against its DuckDB SQL on sf0.001: row count, column
names, column types and the multiset of values must match exactly."""

import pytest

import __spark_entry__ as E
from compare_oracle import compare
from monthwise import catalog, oracle_sql

from conftest import SF_SMALL

ORACLE = oracle_sql.oracle_sql()
NAMES = sorted(catalog.queries())


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_small, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert E.oracle_sql()[name] == ORACLE[name]
    r = compare(name, df, duck_small, ORACLE[name])
    assert r["schema"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert not r["type_mismatch"], r
    assert r["values"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["month_start", "account_segment"]
    assert df.count() > 0
