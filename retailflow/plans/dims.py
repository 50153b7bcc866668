"""Dimension build: route change rows to dimension tables by configuration, keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from retailflow.functions.columns import keep_keys
from retailflow.operators.changelog import live_changes
from retailflow.operators.ordered import first_per_key

# Fixed value: key column of a dimension whose configuration names none.
DEFAULT_KEY = "id"


def route_dimensions(changes: DataFrame, config: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Live change rows of configured source tables, cut down to the configured columns.

    Output: ``sink_table``, ``sink_pk`` (key column name), ``pk`` (key value), ``type``, ``data``, ``ts``,
    ``version`` (the time as a number, which orders the changes) and the ``keep`` columns, such as topic
    offsets that order changes of one second.  Rows of tables without configuration are dropped.
    """
    rules = config.select(
        F.col("sourceTable").alias("table"),
        F.col("sinkTable").alias("sink_table"),
        F.coalesce(F.nullif("sinkPk", F.lit("")), F.lit(DEFAULT_KEY)).alias("sink_pk"),
        F.split("sinkColumns", ",").alias("_columns"),
    )
    routed = live_changes(changes).join(rules, "table", "inner")
    return routed.select(
        "sink_table", "sink_pk", F.col("data")[F.col("sink_pk")].alias("pk"), "type",
        keep_keys(F.col("data"), F.col("_columns")).alias("data"), "ts",
        F.col("ts").try_cast("decimal(20,0)").alias("version"), *keep,
    )


def without_key(routed: DataFrame) -> DataFrame:
    """Rows whose configured key column is not in their data (or null): they belong to no dimension row."""
    return routed.filter("pk is null")


def latest_rows(routed: DataFrame, order: Sequence[str] = ("version",)) -> DataFrame:
    """Current row of each dimension key: the last one in ``order``.  Rows of `without_key` are not among them."""
    return first_per_key(routed.filter("pk is not null"), ["sink_table", "pk"], [F.col(c).desc_nulls_last() for c in order])


def dimension_table(latest: DataFrame, sink_table: str, columns: str) -> DataFrame:
    """One dimension as a table of text columns, named as its configuration lists them."""
    names = columns.split(",")
    return latest.filter(F.col("sink_table") == sink_table).select(
        *[F.col("data")[name].alias(name) for name in names]
    )
