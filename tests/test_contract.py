import pytest
from check_oracle import compare, connect

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
MODELS = {"walk_forward_scores", "model_selection", "tuning_trials", "tuning_adaptive"}


def test_every_query_but_model_training_has_sql():
    optional, _ = contract.training_data()
    assert set(contract.queries()) - set(contract.oracle_sql()) - set(optional) == MODELS
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 49 and not df.isEmpty()


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - set(contract.training_data()[1])))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR) is None


@pytest.mark.parametrize("name", sorted(MODELS))
def test_training_query_has_rows(spark, name):
    assert not contract.queries()[name](spark, SF_DIR).isEmpty()
