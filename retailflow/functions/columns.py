"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

# Amounts are summed exactly, so that the order of addition cannot change a result.
MONEY = "decimal(28,4)"


def money(amount: Column | str) -> Column:
    """Exact amount of a text or numeric column; null when it does not parse."""
    col = F.col(amount) if isinstance(amount, str) else amount
    return col.try_cast(MONEY)


def sum_money(amount: Column | str) -> Column:
    return F.sum(money(amount))


def as_list(names: str | Iterable[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def camel(name: str) -> str:
    head, *tail = name.split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in tail)


def snake_to_camel(df: DataFrame) -> DataFrame:
    """Rename every column from snake_case to camelCase."""
    return df.toDF(*[camel(name) for name in df.columns])


def keep_keys(data: Column, keys: Column) -> Column:
    """Keep the map entries whose key stands in an array of names (exact match, blanks are significant)."""
    return F.map_filter(data, lambda key, _: F.array_contains(keys, key))


def map_text(data: Column) -> Column:
    """A map as ``key=value`` text in key order; a null value is written as an empty string."""
    entries = F.array_sort(F.map_entries(data))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))),
        ",",
    )
