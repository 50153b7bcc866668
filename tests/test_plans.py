"""Plans must stay distributed: no all-pairs joins, no single-task stages, hot keys cut before the shuffle."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_module
from retailflow.operators.changelog import of_table
from retailflow.sources.tables import land_changes
from retailflow.tables import inputs

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_no_all_pairs_and_no_single_task(spark, name):
    text = plan(entry_module.queries()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "PythonUDF", "ArrowEvalPython"):
        assert bad not in text, (name, bad)


@pytest.mark.parametrize("name", ["dedup_first", "dedup_latest", "unique_visitor", "dim_upsert_snapshot"])
def test_one_row_per_key_leaves_each_map_task(spark, name):
    text = plan(entry_module.queries()[name](spark, FOLDER))
    assert re.search(r"WindowGroupLimit .*Partial", text), text


@pytest.mark.parametrize("name", [
    "home_detail_uv_window", "user_login_window", "order_window", "payment_window", "keyword_window",
    "traffic_rollup_window", "province_order_window",
])
def test_windows_aggregate_before_the_shuffle(spark, name):
    text = plan(entry_module.queries()[name](spark, FOLDER))
    assert "partial_" in text


def test_bounce_is_shuffled_by_key_and_slice(spark):
    text = plan(entry_module.queries()["user_jump"](spark, FOLDER))
    assert re.search(r"hashpartitioning\(mid#\d+, _slice#\d+", text), text


def test_large_sides_are_not_broadcast(spark):
    """Beyond the size limit every lookup becomes a sort-merge join."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        for name in ("province_order_window", "user_spu_order_window", "order_wide", "is_new_repair"):
            text = plan(entry_module.queries()[name](spark, FOLDER))
            assert "BroadcastExchange" not in text and "SortMergeJoin" in text, name
    finally:
        spark.conf.set(key, before)


def test_landed_changes_are_pruned_by_table(spark, tmp_path):
    path = str(tmp_path / "changes")
    land_changes(inputs.refund_fact_changes(spark, FOLDER), path)
    landed = spark.read.parquet(path)
    only = of_table(landed, "refund_payment", ["insert"])
    assert re.search(r"PartitionFilters: \[[^\]]*table#\d+ = refund_payment", plan(only))
    expected = of_table(inputs.refund_fact_changes(spark, FOLDER), "refund_payment").count()
    assert only.count() == expected > 0


def test_scans_read_only_what_they_need(spark):
    text = plan(entry_module.queries()["province_order_window"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any(s.startswith("l_orderkey") and "l_tax" not in s and "l_returnflag" not in s for s in schemas)
    assert any("o_orderpriority" not in s and "o_orderdate" in s for s in schemas)
