"""Tumbling event-time windows and the window results built on them.

Every function works in batch and in a streaming query in append mode: the grouping is
``window`` + keys, aggregates are partial before the shuffle, and distinct counts are two-level (first
per distinct value, then per group), so neither a hot group nor a global window is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from retailflow.functions.columns import MONEY, money
from retailflow.functions.times import wall_text

# Fixed value.
WINDOW = "10 seconds"

STT = "stt"
EDT = "edt"


def stamp(grouped: DataFrame, window: str = "window") -> DataFrame:
    """Replace the window column by its start and end as text, first in the row."""
    others = [c for c in grouped.columns if c != window]
    return grouped.select(
        wall_text(F.col(f"{window}.start")).alias(STT),
        wall_text(F.col(f"{window}.end")).alias(EDT),
        *others,
    )


def tumble(
    df: DataFrame, ts: str, keys: Sequence[str], aggregates: Sequence[Column], width: str = WINDOW
) -> DataFrame:
    """Keyed tumbling-window aggregate; no keys means one result row per window."""
    return stamp(df.groupBy(F.window(ts, width), *keys).agg(*aggregates))


def tumble_distinct(
    df: DataFrame, ts: str, keys: Sequence[str], item: str, counted: str,
    amounts: dict[str, str] | None = None, width: str = WINDOW,
) -> DataFrame:
    """Tumbling-window count of distinct ``item`` values, with exact sums of amount columns.

    ``amounts`` maps an amount column to its output name.
    """
    amounts = amounts or {}
    per_item = df.groupBy(F.window(ts, width), *keys, item).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(money(a)).alias(f"_{name}") for a, name in amounts.items()],
    )
    total = per_item.groupBy("window", *keys).agg(
        F.count(item).alias(counted),
        *[F.sum(f"_{name}").cast("double").alias(name) for name in amounts.values()],
    )
    return stamp(total)


def keyword_counts(words: DataFrame, ts: str = "ts", word: str = "word", width: str = WINDOW) -> DataFrame:
    counted = tumble(words, ts, [word], [F.count(F.lit(1)).alias("keyword_count")], width)
    return counted.select(
        STT, EDT, F.lit("search").alias("source"), F.col(word).alias("keyword"), "keyword_count"
    )


def traffic_counters(df: DataFrame, ts: str = "ts", **counters: Column) -> DataFrame:
    """Rows of one traffic input: its keys and 0/1 counters, those not given being zero."""
    zero = F.lit(0).cast("bigint")
    names = ["uv", "sv", "pv", "duration", "uj"]
    return df.select(
        "vc", "ch", "ar", "is_new",
        *[counters.get(name, zero).cast("bigint").alias(name) for name in names], ts,
    )


def page_counters(pages: DataFrame, ts: str = "ts") -> DataFrame:
    return traffic_counters(
        pages, ts, sv=F.col("last_page_id").isNull(), pv=F.lit(1), duration=F.coalesce("during_time", F.lit(0)))


def traffic_rows(pages: DataFrame, visitors: DataFrame, jumps: DataFrame, ts: str = "ts") -> DataFrame:
    """One schema for the three traffic inputs: page rows, daily visitors and bounces as 0/1 counters."""
    one = F.lit(1)
    return traffic_counters(visitors, ts, uv=one).unionByName(traffic_counters(jumps, ts, uj=one)).unionByName(
        page_counters(pages, ts))


def traffic_rollup(rows: DataFrame, ts: str = "ts", width: str = WINDOW, shift_seconds: int = 0) -> DataFrame:
    """Traffic sums by window and channel; ``ts`` may be ``shift_seconds`` after the time whose window is meant."""
    sums = {"uvCt": "uv", "svCt": "sv", "pvCt": "pv", "durSum": "duration", "ujCt": "uj"}
    aggregates = [F.sum(c).alias(name) for name, c in sums.items()]
    keys = ["vc", "ch", "ar", "is_new"]
    if not shift_seconds:
        return tumble(rows, ts, keys, aggregates, width).withColumnRenamed("is_new", "isNew")
    start = f"{shift_seconds % int(pd.Timedelta(width).total_seconds())} seconds"
    shift = F.make_interval(secs=F.lit(shift_seconds))
    rolled = rows.groupBy(F.window(ts, width, width, start), *keys).agg(*aggregates).withColumn("window", F.struct(
        (F.col("window.start") - shift).alias("start"), (F.col("window.end") - shift).alias("end")))
    return stamp(rolled).withColumnRenamed("is_new", "isNew")


def home_detail_window(visitors: DataFrame, ts: str = "ts", width: str = WINDOW) -> DataFrame:
    return tumble(
        visitors, ts, [],
        [F.sum("home").alias("homeUvCt"), F.sum("detail").alias("goodDetailUvCt")], width,
    )


def login_window(logins: DataFrame, ts: str = "ts", width: str = WINDOW) -> DataFrame:
    return tumble(
        logins, ts, [], [F.sum("back").alias("backCt"), F.sum("unique_user").alias("uuCt")], width
    )


def register_window(registered: DataFrame, ts: str = "ts", width: str = WINDOW) -> DataFrame:
    return tumble(registered, ts, [], [F.count(F.lit(1)).alias("registerCt")], width)


def cart_window(users: DataFrame, ts: str = "ts", width: str = WINDOW) -> DataFrame:
    return tumble(users, ts, [], [F.count(F.lit(1)).alias("cartAddUuCt")], width)


def payment_window(payers: DataFrame, ts: str = "ts", width: str = WINDOW) -> DataFrame:
    return tumble(
        payers, ts, [],
        [
            F.sum("unique_user").alias("paymentSucUniqueUserCount"),
            F.sum("new_user").alias("paymentSucNewUserCount"),
        ],
        width,
    )


def order_amounts(details: DataFrame) -> dict[str, Column]:
    """Reduction and original amounts of an order detail; a missing reduction counts as zero."""
    zero = F.lit(0).cast(MONEY)
    return {
        "orderActivityReduceAmount": F.coalesce(money("split_activity_amount"), zero),
        "orderCouponReduceAmount": F.coalesce(money("split_coupon_amount"), zero),
        "orderOriginalTotalAmount": (
            F.col("sku_num").try_cast("int").cast("decimal(10,0)") * money("order_price")
        ),
    }


def order_window(
    details: DataFrame, user: str = "user_id", ts: str = "ts", width: str = WINDOW
) -> DataFrame:
    """Ordering users, first-time users and amounts per window.

    Every detail counts with its amounts; a user counts once a day, in the window of the day's first
    detail.  One pass over the details with two grouping sets gives both parts: sums per window, and
    the first window per user and day.
    """
    amounts = order_amounts(details)
    shaped = details.select(
        F.window(ts, width).alias("window"), F.col(user).alias("user"),
        F.col(ts).cast("date").alias("day"), *[c.alias(n) for n, c in amounts.items()],
    ).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"),
             "user", "day", *amounts)
    grouped = shaped.groupingSets(
        [["start", "end"], ["user", "day"]], "start", "end", "user", "day"
    ).agg(
        F.grouping("start").alias("is_user"),
        F.min("start").alias("first_start"), F.min("end").alias("first_end"),
        *[F.sum(name).alias(name) for name in amounts],
    )
    # User rows have no window yet and window rows have no user, so a partition below holds either the
    # days of one user (bounded by the calendar) or a single window row.
    first_day = F.min("day").over(Window.partitionBy("user", "start"))
    is_user = F.col("is_user") == 1
    merged = grouped.select(
        F.coalesce("start", "first_start").alias("start"),
        F.coalesce("end", "first_end").alias("end"),
        is_user.cast("bigint").alias("unique"),
        (is_user & (F.col("day") == first_day)).cast("bigint").alias("new"),
        *[F.when(~is_user, F.col(name)).alias(name) for name in amounts],
    ).groupBy(F.struct("start", "end").alias("window")).agg(
        F.sum("unique").alias("orderUniqueUserCount"),
        F.sum("new").alias("orderNewUserCount"),
        *[F.sum(name).cast("double").alias(name) for name in amounts],
    )
    return stamp(merged)


def province_order_window(
    details: DataFrame, provinces: DataFrame, ts: str = "ts", province: str = "province_id",
    order: str = "order_id", amount: str = "split_total_amount", width: str = WINDOW,
) -> DataFrame:
    """Distinct orders and amount per province, with the province name (empty when it is unknown)."""
    totals = tumble_distinct(details, ts, [province], order, "orderCount", {amount: "orderAmount"}, width)
    names = provinces.select(F.col("id").alias(province), F.col("name").alias("provinceName"))
    return totals.join(names, province, "left").select(
        STT, EDT, F.col(province).alias("provinceId"),
        F.coalesce("provinceName", F.lit("")).alias("provinceName"), "orderCount", "orderAmount",
    )
