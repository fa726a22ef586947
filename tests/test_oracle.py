"""Every query against its SQL, and checks of the plans."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference
from workload.oracle import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["report_suite", "ods_enrich", "ip_region_join", "area_dictionary",
                                  "tags_per_row", "tag_merge", "skew_lookup_join", "tag_encode"])
def test_plans_stay_in_the_jvm_and_have_no_nested_loops(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("NestedLoop", "CartesianProduct", "Python", "BatchEval"):
        assert word not in plan


def test_report_reads_only_its_columns(spark):
    plan = queries()["report_channel"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double,props:string>" in plan
    assert plan.count("Exchange") == 1


def test_the_log_is_read_twice_for_the_enrichment(spark):
    """Once for the counts of its addresses, and once for the join."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries()["ods_enrich"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.count("props#") >= 1 and plan.count("json_tuple") == 1


def test_skewed_queries_take_the_hot_path(spark):
    assert [r.c_custkey for r in queries()["skew_hot_keys"](spark, SF).collect()] == [1]
    plan = queries()["skew_hot_lookup_join"](spark, SF)._jdf.queryExecution().analyzed().toString()
    assert "_hot" in plan
