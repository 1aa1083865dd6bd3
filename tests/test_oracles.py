"""Every registered query against its DuckDB oracle (the driver's gate)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE, SF_SMALL
from tools.check_oracles import compare


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "cheapest_suppkey" in df.columns


def test_every_catalogue_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_all_queries_match_oracle(spark, sf):
    res = compare(spark, sf, list(E.oracle_sql()))
    bad = {k: v for k, v in res.items() if not v[0].startswith("ok")}
    assert not bad, bad
