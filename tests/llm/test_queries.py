"""The registered queries that SQL can express, against it."""

import pytest

from tagloom.llm.oracle import ORACLES
from tagloom.llm.queries import QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op3_quality", "op9_chat"])
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "BatchEval", "CartesianProduct"):
        assert word not in plan
