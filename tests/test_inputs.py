"""Change rows of items: what is shuffled, and rows that no text names."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from retailflow.tables import inputs

FOLDER = "/root/testdata/sf0.001"


def test_change_rows_of_items_are_shuffled_once(spark):
    """Details, activities and coupons join on the id they are grouped by, and no map is made only to be read."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4096")
    try:
        plan = entry_module.queries()["order_wide"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(id#") == 3
    assert "map(id" not in plan and "Window" not in plan


def test_latest_item_without_a_key_stays(spark, tmp_path):
    """An id of null is one item, and of equal versions the greater part wins, nulls last."""
    day = F.lit("2024-01-01").cast("timestamp_ntz")
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, " \
              "l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    rows = [(1, 5, 1, 1, 1.0, 9.0, 0.1, 0.0, "R", "F"), (1, 7, 1, 1, 2.0, 8.0, 0.0, 0.0, "N", "O"),
            (1, None, 1, 1, 3.0, 8.0, 0.0, 0.0, "N", "O"), (2, 4, 1, None, 4.0, 1.0, 0.0, 0.0, "N", "O")]
    spark.createDataFrame(rows, columns).withColumn("l_shipdate", day).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = inputs.detail_changes(spark, str(tmp_path)).select(F.col("data")["id"], F.col("data")["sku_num"]).collect()
    assert sorted(map(tuple, found), key=str) == [("11", "2"), (None, "4")]
    assert inputs.activity_changes(spark, str(tmp_path)).count() == 0


def test_log_texts_are_not_stored_with_their_records(spark, tmp_path, monkeypatch):
    from retailflow.tables import catalog

    monkeypatch.setattr(catalog, "scratch_path", lambda session, name: str(tmp_path / name))
    catalog.QUERIES["log_page"](spark, FOLDER)
    stored = spark.read.parquet(str(tmp_path / "logs"))
    assert not {"value", "dirty"} & set(stored.columns)
    assert stored.count() < spark.read.parquet(f"{FOLDER}/events.parquet").count()


def test_runs_are_cut_by_a_given_number_of_tasks(spark):
    plan = entry_module.queries()["keyword_han"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
