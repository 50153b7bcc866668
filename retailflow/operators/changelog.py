"""Filters and projections over database change rows ``database, table, type, data, old, ts``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retailflow import schemas

# Operation types that carry a current row.
INSERT = "insert"
UPDATE = "update"
BOOTSTRAP = "bootstrap-insert"
LIVE_TYPES = (INSERT, UPDATE, BOOTSTRAP)


def live_changes(changes: DataFrame) -> DataFrame:
    """Rows that state a current value: inserts, updates and rows of an initial load."""
    return changes.filter(F.col("type").isin(*LIVE_TYPES))


def of_table(
    changes: DataFrame, table: str, types: Sequence[str] | None = None, database: str | None = None
) -> DataFrame:
    """Changes of one source table; ``types`` and ``database`` narrow it further when given.

    A plain conjunction on ``table``, so a change table partitioned by it is pruned to one folder.
    """
    condition = F.col("table") == table
    if database is not None:
        condition &= F.col("database") == database
    if types is not None:
        condition &= F.col("type").isin(*types)
    return changes.filter(condition)


def fields(names: Sequence[str], renames: dict[str, str] | None = None) -> list[Column]:
    """Values of the ``data`` map as columns, some under a new name."""
    renames = renames or {}
    return [F.col("data")[name].alias(renames.get(name, name)) for name in names]


def table_columns(table: str, renames: dict[str, str] | None = None) -> list[Column]:
    return fields(schemas.SOURCE_KEYS[table], renames)


def changed(key: str) -> Column:
    """The change touched this column: its former value is recorded."""
    return F.col("old")[key].isNotNull()


def cart_additions(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Cart rows that put something in: new rows, and updates that raise ``sku_num``.

    ``sku_num`` becomes the number added; text that is not a number gives null, not an error.
    """
    now = F.col("data")["sku_num"].try_cast("int")
    before = F.col("old")["sku_num"].try_cast("int")
    inserted = F.col("type") == INSERT
    raised = (F.col("type") == UPDATE) & changed("sku_num") & (now > before)
    added = F.when(inserted, F.col("data")["sku_num"]).otherwise((now - before).cast("string"))
    columns = [
        added.alias("sku_num") if name == "sku_num" else F.col("data")[name].alias(name)
        for name in schemas.SOURCE_KEYS["cart_info"]
    ]
    return of_table(changes, "cart_info", database=database).filter(inserted | raised).select(*columns)
