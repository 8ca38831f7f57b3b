"""Every registered query against its independent DuckDB SQL (row count, columns, values)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare
from conftest import SF_SMALL

NAMES = sorted(E.oracle_sql())


def test_every_query_has_oracle_sql():
    ours = {n for n in E.queries() if n != "pipeline" and not n.startswith("op")}
    assert ours <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["url"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res[0] == "OK", res
