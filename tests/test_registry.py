"""Every registered query against its SQL, and the shape of its plan."""

import pytest
from conftest import SF

import __spark_entry__ as contract
from fixtures import oracle, registry
from fixtures.compare import differences, duck

SQL = oracle.oracle_sql()
QUERIES = registry.queries()
# histogram trees are scored in Arrow batches
ARROW = {"histogram_two_features"}
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_entry_is_one_kpi_row(spark):
    assert contract.entry(spark).count() == 1


def test_every_sql_text_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    fitted = {
        "lr_scores",
        "gbt_scores",
        "histogram_scores",
        "model_comparison",
        "locked_test_predictions",
        "batch_scoring",
        "model_info",
    }
    assert set(QUERIES) - set(SQL) == fitted


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, connection, name):
    assert differences(spark, connection, SF, QUERIES[name], SQL[name]) == []


@pytest.mark.parametrize("name", sorted(SQL))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    found = [word for word in BANNED if word in plan]
    assert found == (["EvalPython"] if name in ARROW else [])
    assert "BatchEvalPython" not in plan
