"""Every registered query against its DuckDB oracle on sf0.001, plus the
driver's smoke entry."""

import pytest

import __spark_entry__ as se
from contract_lake.plans import catalog
from tests.oracle_harness import compare

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["user_id", "feature_id", "event_type", "value", "k",
                          "valid_from", "valid_to", "is_current"]


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res["ok"], res
