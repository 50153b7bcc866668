"""Row shapes at the sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def json_lines(df: DataFrame) -> DataFrame:
    """Every row as one JSON text in ``value``."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def positional(df: DataFrame, hidden: Sequence[str] = ()) -> DataFrame:
    """Columns in their order without the hidden ones, as a positional insert takes them."""
    return df.select(*[c for c in df.columns if c not in set(hidden)])


def with_write_time(df: DataFrame, name: str = "ts") -> DataFrame:
    """Append the wall-clock milliseconds of writing."""
    return df.withColumn(name, F.unix_millis(F.current_timestamp()))
