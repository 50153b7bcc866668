"""Compare a registered query with its SQL by value, whatever the row order."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[name]):
            df[name] = df[name].astype("datetime64[us]")
        elif pd.api.types.is_integer_dtype(df[name]) or pd.api.types.is_bool_dtype(df[name]):
            df[name] = df[name].astype("float64")
        elif df[name].dtype == object or pd.api.types.is_string_dtype(df[name]):
            df[name] = df[name].astype(object).where(df[name].notna(), None)
    keys = df.astype(str)
    return df.loc[keys.sort_values(list(keys.columns)).index].reset_index(drop=True)


def assert_same(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame, name: str) -> None:
    assert sorted(spark_rows.columns) == sorted(sql_rows.columns), (
        name, sorted(spark_rows.columns), sorted(sql_rows.columns))
    assert len(spark_rows) == len(sql_rows), (name, len(spark_rows), len(sql_rows))
    pd.testing.assert_frame_equal(
        normal(spark_rows), normal(sql_rows), check_dtype=False, obj=name, rtol=0, atol=0
    )
