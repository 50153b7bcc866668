from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from retailflow.operators import visits, windows
from retailflow.operators.ordered import keep_first, keep_latest

BASE = dt.datetime(2022, 4, 1, 12, 0, 0)
PAGE = "mid STRING, uid STRING, page_id STRING, last_page_id STRING, ts TIMESTAMP_NTZ, n INT"


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def pages(spark, rows):
    """rows: (mid, last_page_id, seconds)"""
    return spark.createDataFrame(
        [(m, "u" + m, "home", last, at(s), n) for n, (m, last, s) in enumerate(rows)], PAGE
    )


def test_bounce_boundaries(spark):
    rows = [
        ("a", None, 0), ("a", "home", 9.999),      # followed in time: no bounce
        ("b", None, 0), ("b", "home", 10),         # exactly the span: bounce
        ("c", None, 0), ("c", None, 1),            # entry after entry: both bounce (last has none after)
        ("d", None, 0),                            # alone: bounce
        ("e", "home", 0),                          # no entry
        ("f", None, 119.5), ("f", "home", 125),    # successor in the next slice
    ]
    got = visits.user_jumps(pages(spark, rows), ties=["n"]).select("mid", "n").collect()
    assert sorted((r["mid"], r["n"]) for r in got) == [("b", 2), ("c", 4), ("c", 5), ("d", 6)]


def replay_jumps(rows, span):
    by_mid = {}
    for n, (mid, last, s) in enumerate(rows):
        by_mid.setdefault(mid, []).append((at(s), n, last))
    out = []
    for events in by_mid.values():
        events.sort(key=lambda e: e[:2])
        for cur, nxt in zip(events, [*events[1:], None]):
            if cur[2] is None and (
                nxt is None or nxt[2] is None or nxt[0] - cur[0] >= dt.timedelta(seconds=span)
            ):
                out.append(cur[1])
    return sorted(out)


def test_bounce_against_replay_with_a_hot_device(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(3000):
        mid = "hot" if rng.random() < 0.34 else f"m{rng.randrange(60)}"
        rows.append((mid, rng.choice([None, "home"]), rng.choice([rng.random() * 4000, rng.randrange(4000)])))
    frame = pages(spark, rows)
    for span in (3, 10, 60):
        got = visits.user_jumps(frame, ties=["n"], span_seconds=span).select("n").collect()
        assert sorted(r["n"] for r in got) == replay_jumps(rows, span)


def test_unique_visitor(spark):
    day = 24 * 3600
    rows = [
        ("a", None, 0), ("a", None, 5), ("a", None, day), ("a", "home", -5),
        ("b", None, day), ("b", None, day + 1),
    ]
    got = visits.unique_visitors(pages(spark, rows), ties=["n"]).select("n").collect()
    assert sorted(r["n"] for r in got) == [0, 2, 4]


def test_login_return_boundary(spark):
    day = 24 * 3600
    rows = [("a", None, 0), ("a", "login", 7 * day), ("b", None, 0), ("b", None, 8 * day), ("b", "home", 9 * day)]
    got = visits.login_visitors(pages(spark, rows))
    assert sorted((r["ts"], r["back"]) for r in got.collect()) == sorted(
        [(at(0), 0), (at(7 * day), 0), (at(0), 0), (at(8 * day), 1)])


def test_payment_users(spark):
    day = 24 * 3600
    rows = [("a", None, 0), ("a", None, 60), ("a", None, day), ("b", None, 30)]
    got = visits.paying_users(pages(spark, rows), "mid", "ts").collect()
    assert sorted((r["ts"], r["unique_user"], r["new_user"]) for r in got) == [
        (at(0), 1, 1), (at(30), 1, 1), (at(day), 1, 0)]


def test_home_and_detail_counters(spark):
    rows = [("a", "home", 0, "u"), ("a", "good_detail", 1, "u"), ("a", "home", 2, "u"), ("b", "cart", 3, "u")]
    frame = spark.createDataFrame(
        [(m, u, p, None, at(s), i) for i, (m, p, s, u) in enumerate(rows)], PAGE)
    out = windows.home_detail_window(visits.home_detail_visitors(frame)).collect()
    assert [tuple(r) for r in out] == [("2022-04-01 12:00:00", "2022-04-01 12:00:10", 1, 1)]


def test_dedup(spark):
    rows = [(1, "a", at(0), 0), (1, "b", at(5), 1), (1, "c", at(5), 2), (2, "d", at(1), 3)]
    frame = spark.createDataFrame(rows, "id INT, v STRING, row_op_ts TIMESTAMP_NTZ, n INT")
    latest = keep_latest(frame, "id", "row_op_ts", ["n"])
    assert sorted(r["v"] for r in latest.collect()) == ["c", "d"]
    first = keep_first(frame, "id", ["n"])
    assert sorted(r["v"] for r in first.collect()) == ["a", "d"]
    # duplicated input and another row order change nothing
    again = keep_latest(frame.unionByName(frame).orderBy(F.rand(1)), "id", "row_op_ts", ["n"])
    assert sorted(r["v"] for r in again.collect()) == ["c", "d"]


def details(spark, rows):
    """rows: (id, order, user, province, seconds, sku_num, price, activity, coupon)"""
    return spark.createDataFrame(
        [(i, o, u, p, at(s), n, pr, a, c, pr) for i, o, u, p, s, n, pr, a, c in rows],
        "id STRING, order_id STRING, user_id STRING, province_id STRING, ts TIMESTAMP_NTZ, sku_num STRING,"
        " order_price STRING, split_activity_amount STRING, split_coupon_amount STRING,"
        " split_total_amount STRING",
    )


def test_order_window(spark):
    day = 24 * 3600
    frame = details(spark, [
        ("1", "o1", "u1", "p", 0, "2", "10.10", "1.50", None),
        ("2", "o1", "u1", "p", 1, "1", "5.05", None, "0.25"),
        ("3", "o2", "u1", "p", 11, "1", "1.00", None, None),
        ("4", "o3", "u2", "p", 12, "1", "1.00", None, None),
        ("5", "o4", "u1", "p", day, "1", "3.00", None, None),
    ])
    got = {r["stt"]: tuple(r)[2:] for r in windows.order_window(frame).collect()}
    assert got == {
        "2022-04-01 12:00:00": (1, 1, 1.5, 0.25, 25.25),
        "2022-04-01 12:00:10": (1, 1, 0.0, 0.0, 2.0),
        "2022-04-02 12:00:00": (1, 0, 0.0, 0.0, 3.0),
    }


def test_province_window(spark):
    frame = details(spark, [
        ("1", "o1", "u1", "1", 0, "1", "10.10", None, None),
        ("2", "o1", "u1", "1", 1, "1", "0.20", None, None),
        ("3", "o2", "u1", "1", 2, "1", "1.00", None, None),
        ("4", "o3", "u2", "9", 3, "1", "1.00", None, None),
        ("5", "o1", "u1", "1", 10, "1", "1.00", None, None),
    ])
    provinces = spark.createDataFrame([("1", "Beijing")], "id STRING, name STRING")
    got = sorted(tuple(r) for r in windows.province_order_window(frame, provinces).collect())
    assert got == [
        ("2022-04-01 12:00:00", "2022-04-01 12:00:10", "1", "Beijing", 2, 11.3),
        ("2022-04-01 12:00:00", "2022-04-01 12:00:10", "9", "", 1, 1.0),
        ("2022-04-01 12:00:10", "2022-04-01 12:00:20", "1", "Beijing", 1, 1.0),
    ]
