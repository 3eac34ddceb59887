"""What the physical plans must and must not hold."""

import re

import pytest

import __spark_entry__ as entry
from tidemark.registry import REGISTRY

SF = "/root/testdata/sf0.001"
QUERIES = {k: q for k, q in entry.queries().items() if k in REGISTRY}
TRAINED = {"churn_train", "batch_scoring", "feature_importance"}
ONE_ROW_SIDE = {"anomaly_volume", "volume_having", "model_gate"}  # a threshold of one row


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - TRAINED))
def test_no_cross_join_and_no_python(spark, key):
    plan = plan_of(QUERIES[key](spark, SF))
    assert "CartesianProduct" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    if key not in ONE_ROW_SIDE:
        assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("key", ["customer_features", "retention_keep", "ingest_incremental"])
def test_date_bounds_reach_the_scan(spark, key):
    plan = plan_of(QUERIES[key](spark, SF))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert any("GreaterThan" in p and "o_orderdate" in p for p in pushed), pushed


def test_columns_are_pruned(spark):
    plan = plan_of(QUERIES["kpi_channel"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    names = {f.split(":")[0] for s in schemas for f in s.split(",")}
    assert names == {"o_orderkey", "o_orderdate", "l_orderkey", "l_partkey", "l_extendedprice", "l_discount"}


@pytest.mark.parametrize("key", ["vector_topk", "retrieval_hit_rate"])
def test_topk_is_cut_before_the_shuffle(spark, key):
    assert "WindowGroupLimit" in plan_of(QUERIES[key](spark, SF))


@pytest.mark.parametrize("key", ["dedup_latest", "unique_combination", "customer_activity", "kpi_month_category"])
def test_groups_are_reduced_before_the_shuffle(spark, key):
    plan = plan_of(QUERIES[key](spark, SF))
    assert "partial_" in plan
    assert "Window" not in plan


@pytest.mark.parametrize("key, table, scans", [("unique_violations", "part", 1), ("features_point_in_time", "lineitem", 1)])
def test_a_mart_is_read_once_for_all_its_checks(spark, key, table, scans):
    plan = plan_of(QUERIES[key](spark, SF))
    assert len(re.findall(rf"FileScan[^\n]*/{table}\.parquet", plan)) == scans


def test_one_plan_at_every_size(spark):
    def shape(sf):
        text = plan_of(QUERIES["fct_orders"](spark, f"/root/testdata/{sf}"))
        return [re.sub(r"[#\[({<].*| \(\d+\)", "", line).strip(" +-:*") for line in text.splitlines() if "Scan" not in line]

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # else Spark's own size check decides
    try:
        assert shape("sf0.001") == shape("sf0.01") == shape("sf0.1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
