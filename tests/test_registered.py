"""Every registered query against its SQL on the same tables."""

import pytest
from compare import differences

import __spark_entry__ as contract
from fleetfeatures import catalogue

QUERIES, ORACLES = catalogue.QUERIES, catalogue.ORACLES
WITHOUT_SQL = {"grid_lr", "grid_rf", "grid_gbt", "train_eval", "run_log", "score_batch"}


def test_every_query_but_the_model_fits_has_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), ORACLES[name], sf) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() == 1000
    assert "route_description" in result.columns
