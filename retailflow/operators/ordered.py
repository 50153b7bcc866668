"""Ordered, per-key operators written so that one hot key never lands whole in one task.

* First or last row per key: Spark limits each key to one row per map task before the shuffle
  (``WindowGroupLimit``), so a key that holds a third of the table sends a handful of rows.
* First row per key and day: a partial aggregate, again one row per key, day and map task.
* The row that follows within a time span: time is cut into overlapping slices, and the shuffle key is
  (key, slice), so a hot key is spread over its slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from retailflow.functions.columns import as_list

# Width of one slice of `following_within`, in multiples of the span: about one row in twelve is sent twice.
_SLICE_SPANS = 12


def order_key(columns: Sequence[str]) -> Column:
    """One sortable value for several columns; a single column stays as it is (hash aggregation)."""
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def first_per_key(df: DataFrame, keys: str | list[str], order: list[Column]) -> DataFrame:
    """One whole row per key: the first in ``order``, which must break every tie."""
    rank = F.row_number().over(Window.partitionBy(*as_list(keys)).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: str | list[str], arrival: list[str]) -> DataFrame:
    """Keep the row that arrived first for each id."""
    return first_per_key(df, keys, [F.col(c).asc_nulls_last() for c in arrival])


def keep_latest(df: DataFrame, keys: str | list[str], version: str, arrival: list[str]) -> DataFrame:
    """Keep the newest version of each id; equal versions are decided by later arrival."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in [version, *arrival]])


def day_firsts(df: DataFrame, key: str, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """Earliest event time per key (and ``by`` columns) and calendar day.

    In event-time order a row whose day differs from the previous row's day is the first row of its
    day, so the per-key state "last seen day" needs no row-by-row scan.
    """
    return df.groupBy(key, *by, F.col(ts).cast("date").alias("day")).agg(F.min(ts).alias(ts))


def with_previous_day(firsts: DataFrame, key: str) -> DataFrame:
    """Add the previous active day of each key to the output of `day_firsts`.

    The input has at most one row per key and day, so a partition is bounded by the number of days.
    """
    return firsts.withColumn("previous_day", F.lag("day").over(Window.partitionBy(key).orderBy("day")))


def following_within(
    df: DataFrame,
    key: str,
    ts: str,
    span_seconds: int,
    look: dict[str, str],
    ties: Sequence[str] = (),
) -> DataFrame:
    """Add columns of the next row of the same key if it comes less than ``span_seconds`` later.

    ``look`` maps a column of the following row to an output name; ``has_next`` tells whether there is
    such a row.  Rows are ordered by ``ts`` and then ``ties``.
    """
    own = span_seconds * _SLICE_SPANS
    # Slices overlap by one span: a row also belongs to the slice before it if that slice's last rows
    # could need it as their successor.
    slices = F.window(ts, f"{own + span_seconds} seconds", f"{own} seconds")
    sliced = df.withColumn("_slice", slices).withColumn("_slice", F.col("_slice.start"))
    w = Window.partitionBy(key, "_slice").orderBy(ts, *ties)
    next_ts = F.lead(ts).over(w)
    near = F.col("_next_ts") < F.col(ts) + F.expr(f"interval {span_seconds} seconds")
    out = sliced.withColumn("_next_ts", next_ts)
    for source, name in look.items():
        out = out.withColumn(name, F.lead(source).over(w))
    out = out.filter(F.col(ts) < F.col("_slice") + F.expr(f"interval {own} seconds"))
    out = out.withColumn("has_next", F.coalesce(near, F.lit(False)))
    for name in look.values():
        out = out.withColumn(name, F.when(F.col("has_next"), F.col(name)))
    return out.drop("_slice", "_next_ts")
