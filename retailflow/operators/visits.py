"""Per-visitor operators over page rows: entries, daily visitors, bounces, logins.

Batch forms order by event time, with ``ties`` to make the order total.  Streaming twins that keep
keyed state are in `retailflow.streaming.keyed`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retailflow.operators.ordered import day_firsts, first_per_key, following_within, with_previous_day

# Fixed values.
BOUNCE_SECONDS = 10
RETURN_DAYS = 8
HOME_PAGE = "home"
DETAIL_PAGE = "good_detail"
LOGIN_PAGE = "login"


def is_entry(last_page: str = "last_page_id") -> Column:
    """A page reached from outside: the session starts here."""
    return F.col(last_page).isNull()


def is_login(uid: str = "uid", last_page: str = "last_page_id") -> Column:
    return F.col(uid).isNotNull() & (is_entry(last_page) | (F.col(last_page) == LOGIN_PAGE))


def unique_visitors(
    pages: DataFrame, key: str = "mid", ts: str = "ts", last_page: str = "last_page_id",
    ties: Sequence[str] = (),
) -> DataFrame:
    """First session entry of each device and day, whole row."""
    entries = pages.filter(is_entry(last_page)).withColumn("_day", F.col(ts).cast("date"))
    return first_per_key(entries, [key, "_day"], [F.col(c) for c in [ts, *ties]]).drop("_day")


def user_jumps(
    pages: DataFrame, key: str = "mid", ts: str = "ts", last_page: str = "last_page_id",
    ties: Sequence[str] = (), span_seconds: int = BOUNCE_SECONDS,
) -> DataFrame:
    """Session entries that were not followed by another page within the span.

    The next row decides: none within the span is a bounce, another entry is a bounce, any other page is
    not.  A gap of exactly the span counts as none.
    """
    marked = pages.withColumn("_entry", is_entry(last_page))
    looked = following_within(marked, key, ts, span_seconds, {"_entry": "_next_entry"}, ties)
    bounce = F.col("_entry") & (~F.col("has_next") | F.col("_next_entry"))
    return looked.filter(bounce).select(*pages.columns)


def home_detail_visitors(
    pages: DataFrame, key: str = "mid", ts: str = "ts", page: str = "page_id"
) -> DataFrame:
    """Event time and 0/1 counters of the first home and first detail page of each device and day."""
    seen = pages.filter(F.col(page).isin(HOME_PAGE, DETAIL_PAGE))
    return day_firsts(seen, key, ts, [page]).select(
        ts,
        (F.col(page) == HOME_PAGE).cast("bigint").alias("home"),
        (F.col(page) == DETAIL_PAGE).cast("bigint").alias("detail"),
    )


def login_visitors(
    pages: DataFrame, uid: str = "uid", ts: str = "ts", last_page: str = "last_page_id"
) -> DataFrame:
    """First login of each user and day, with ``back`` = 1 after a gap of eight days or more."""
    firsts = with_previous_day(day_firsts(pages.filter(is_login(uid, last_page)), uid, ts), uid)
    gap = F.date_diff("day", "previous_day")
    return firsts.select(
        ts,
        F.lit(1).cast("bigint").alias("unique_user"),
        F.coalesce((gap >= RETURN_DAYS).cast("bigint"), F.lit(0)).alias("back"),
    )


def daily_users(df: DataFrame, user: str, ts: str) -> DataFrame:
    """First event of each user and day."""
    return day_firsts(df, user, ts).select(user, ts)


def paying_users(df: DataFrame, user: str, ts: str) -> DataFrame:
    """First payment of each user and day; ``new_user`` = 1 on the user's first day ever."""
    firsts = with_previous_day(day_firsts(df, user, ts), user)
    return firsts.select(
        ts,
        F.lit(1).cast("bigint").alias("unique_user"),
        F.col("previous_day").isNull().cast("bigint").alias("new_user"),
    )
