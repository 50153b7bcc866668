"""Streams replayed from files must give what the batch operators give."""

from __future__ import annotations

import json
import os
import random
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from retailflow import schemas
from retailflow.functions.keywords import explode_words
from retailflow.operators import logs, lookup, visits, windows
from retailflow.operators.ordered import keep_first
from retailflow.plans import facts
from retailflow.plans import windows as plan_windows
from retailflow.session import checkpoint_root
from retailflow.sources.records import changelog_rows, file_lines
from retailflow.sources.tables import dimension_config, stored_rows
from retailflow.sinks.tables import keyed_table
from retailflow.streaming import jobs, joins, keyed
from retailflow.streaming.late import ChangeStore, CompletedFact

NOON = 1648785600000  # 2022-04-01 12:00:00 +08:00
DAY = 24 * 3600 * 1000
PAGE_SCHEMA = (
    "mid STRING, uid STRING, vc STRING, ch STRING, ar STRING, is_new STRING, page_id STRING,"
    " last_page_id STRING, during_time BIGINT, ms BIGINT, ts TIMESTAMP"
)
KEEP = ["mid", "vc", "ch", "ar", "is_new", "page_id", "ms", "ts"]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return tmp_path_factory.mktemp("streams")


def put_files(folder, chunks):
    """One text file per chunk, in order of time."""
    folder.mkdir(parents=True)
    for i, chunk in enumerate(chunks):
        path = folder / f"{i:04d}.txt"
        path.write_text("\n".join(chunk) + "\n", encoding="utf-8")
        stamp = 1_600_000_000 + i
        os.utime(path, (stamp, stamp))
        time.sleep(0.01)
    return str(folder)


def run(df, name, root, write=None, mode="append"):
    """Run a stream over what is there and return the folder it wrote."""
    out = str(root / f"out-{name}")
    query = jobs.start(df, name, write or jobs.table_writer(out), mode=mode)
    query.awaitTermination()
    assert query.exception() is None
    return out


def rows(df, columns=None):
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def page_records(seed=1, n=240):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        mid = "hot" if rng.random() < 0.34 else f"m{rng.randrange(12)}"
        out.append({
            "mid": mid, "uid": rng.choice([None, "u" + mid]), "vc": rng.choice("12"), "ch": "c", "ar": "a",
            "is_new": rng.choice("01"), "page_id": rng.choice(["home", "good_detail", "cart"]),
            "last_page_id": rng.choice([None, "login", "home"]), "during_time": rng.randrange(9),
            "ms": NOON + rng.randrange(0, 3) * DAY * 5 + rng.randrange(0, 200_000),
        })
    out.sort(key=lambda r: r["ms"])
    return out


def page_lines(records):
    return [json.dumps({k: v for k, v in r.items() if v is not None}) for r in records]


def flat_pages(lines):
    schema = PAGE_SCHEMA.replace(", ts TIMESTAMP", "")
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*").withColumn(
        "ts", F.timestamp_millis("ms")
    )


@pytest.fixture(scope="module")
def page_folder(root):
    records = page_records()
    flush = dict(records[-1], mid="flush", uid="flush", page_id="cart", last_page_id="home",
                 ms=records[-1]["ms"] + 20 * DAY)
    lines = page_lines(records)
    chunks = [lines[i:i + 60] for i in range(0, len(lines), 60)]
    return put_files(root / "pages", [*chunks, page_lines([flush])])


def page_stream(spark, folder):
    return flat_pages(file_lines(spark, folder, stream=True, files_per_trigger=1))


def page_batch(spark, folder):
    return flat_pages(file_lines(spark, folder))


def test_unique_visitors_and_restart(spark, root, page_folder):
    stream = jobs.unique_visitors(page_stream(spark, page_folder), KEEP)
    out = run(stream, "uv", root, mode="update")
    expected = rows(visits.unique_visitors(page_batch(spark, page_folder)), ["mid", "ms"])
    assert rows(spark.read.parquet(out), ["mid", "ms"]) == expected
    # a restart from the checkpoint neither loses nor repeats rows
    run(jobs.unique_visitors(page_stream(spark, page_folder), KEEP), "uv", root, mode="update")
    assert rows(spark.read.parquet(out), ["mid", "ms"]) == expected


def test_user_jumps(spark, root, page_folder):
    out = run(jobs.user_jumps(page_stream(spark, page_folder), KEEP), "uj", root)
    got = spark.read.parquet(out).filter("mid <> 'flush'")
    batch = visits.user_jumps(page_batch(spark, page_folder)).filter("mid <> 'flush'")
    assert rows(got, ["mid", "ms"]) == rows(batch, ["mid", "ms"])
    assert sum(rows(batch, ["mid"]).values()) > 10


def test_user_jumps_out_of_order_within_the_delay(spark, root):
    def page(last, ms, mid="a"):
        return json.dumps({"mid": mid, "ms": ms, **({"last_page_id": last} if last else {})})

    # the follower at +1 s arrives a batch later than a row at +2 s of another device
    folder = put_files(root / "late", [
        [page(None, NOON), page(None, NOON + 2000, "b")], [page("home", NOON + 1000)],
        [page("x", NOON + DAY, "z")], [page("x", NOON + DAY + 1, "z")],
    ])
    out = run(jobs.user_jumps(page_stream(spark, folder), ["mid", "ms"]), "uj-late", root)
    assert rows(spark.read.parquet(out), ["mid", "ms"]) == Counter([("b", NOON + 2000)])


def day_stream(spark, path):
    """Stored first rows of a day as a stream."""
    return stored_rows(spark, f"{path}/batch=*", jobs.USER_DAYS, stream=True)


def test_home_detail_and_login(spark, root, page_folder):
    out = run(jobs.home_detail_visitors(page_stream(spark, page_folder)), "hd", root, mode="update")
    expected = visits.home_detail_visitors(page_batch(spark, page_folder))
    assert rows(spark.read.parquet(out), ["ts", "home", "detail"]) == rows(expected)
    firsts = run(jobs.daily_logins(page_stream(spark, page_folder)), "logins", root, mode="update")
    out = run(jobs.login_visitors(day_stream(spark, firsts)), "login", root)
    expected = visits.login_visitors(page_batch(spark, page_folder))
    assert rows(spark.read.parquet(out), ["ts", "unique_user", "back"]) == rows(expected)


def test_daily_state_is_in_the_jvm_and_bounded(spark, root):
    """A device that is there every day in two files a day: one row a day comes out, two days stay in state."""
    days = [[json.dumps({"mid": m, "ms": NOON + d * DAY + h}) for m in "abc"] for d in range(6) for h in (0, 1000)]
    folder = put_files(root / "days", days)
    plans = []

    def write(df, batch_id):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        df.write.mode("append").parquet(str(root / "days-out"))

    query = jobs.start(jobs.unique_visitors(page_stream(spark, folder), ["mid", "ms"]), "days", write, mode="update")
    query.awaitTermination()
    assert rows(spark.read.parquet(str(root / "days-out"))) == Counter(
        (m, NOON + d * DAY) for m in "abc" for d in range(6))
    assert plans and not any("Python" in p or "Pandas" in p or "Arrow" in p for p in plans)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 9


def test_earliest_row_of_a_batch_wins_whatever_the_order(spark, root):
    folder = put_files(root / "mixed", [[json.dumps({"mid": "a", "ms": NOON + s}) for s in (5000, 3000, 9000)],
                                        [json.dumps({"mid": "a", "ms": NOON + 1})]])
    out = run(jobs.unique_visitors(page_stream(spark, folder), ["mid", "ms"]), "mixed", root, mode="update")
    assert rows(spark.read.parquet(out), ["mid", "ms"]) == {("a", NOON + 3000): 1}


def test_a_new_query_goes_on_from_stored_history(spark, root):
    """The first half is history from the batch form, the second a stream with a checkpoint of its own."""
    records = [{"user": u, "ms": NOON + d * DAY} for u, d in [
        ("a", 0), ("b", 0), ("a", 1), ("b", 9), ("a", 12), ("c", 12), ("c", 13), ("b", 13)]]
    shape = "user string, ms long"

    def firsts(df):
        return df.select("user", F.timestamp_millis("ms").alias("ts")).withColumn("day", F.col("ts").cast("date"))

    def frame(part):
        return firsts(spark.createDataFrame([(r["user"], r["ms"]) for r in part], shape))

    folder = put_files(root / "second-half", [[json.dumps(r)] for r in records[3:]])
    lines = file_lines(spark, folder, True, 2).select(F.from_json("value", shape).alias("r")).select("r.*")
    out = run(jobs.paying_users(firsts(lines), history=frame(records[:3])), "go-on", root)
    whole = rows(visits.paying_users(frame(records), "user", "ts"))
    assert rows(spark.read.parquet(out), ["ts", "unique_user", "new_user"]) == whole - rows(
        visits.paying_users(frame(records[:3]), "user", "ts"))
    assert sum(rows(spark.read.parquet(out).filter("new_user = 1")).values()) == 1
    # Started again, it goes on from its own state and not from the history.
    (root / "second-half" / "9999.txt").write_text(json.dumps({"user": "c", "ms": NOON + 14 * DAY}) + "\n", encoding="utf-8")
    run(jobs.paying_users(firsts(lines), history=frame(records[:3])), "go-on", root)
    got = rows(spark.read.parquet(out), ["ts", "unique_user", "new_user"])
    assert sum(got.values()) == 6 and sum(n for (_, _, new), n in got.items() if new) == 1


def test_a_day_that_comes_late_is_no_new_user(spark, root):
    rows_ = [("a", 5), ("a", 4), ("a", 6), ("a", 20)]
    folder = put_files(root / "late-days", [[json.dumps({"user": u, "ms": NOON + d * DAY})] for u, d in rows_])
    lines = file_lines(spark, folder, True, 1).select(F.from_json("value", "user string, ms long").alias("r")).select("r.*")
    firsts = lines.select("user", F.timestamp_millis("ms").alias("ts")).withColumn("day", F.col("ts").cast("date"))
    out = run(jobs.login_visitors(firsts), "late-days", root)
    assert sorted(r["back"] for r in spark.read.parquet(out).collect()) == [0, 0, 0, 1]


def test_a_device_with_very_many_pages(spark, root):
    """One device sends most rows in one batch: state and time grow with the rows, not with their square."""
    def pages(n, start):
        return [json.dumps({"mid": "hot", "ms": NOON + start + i * 5, **({} if i % 3 == 0 else {"last_page_id": "x"})})
                for i in range(n)]

    seconds = {}
    for n in (5_000, 20_000):
        folder = put_files(root / f"many{n}", [pages(n, 0), pages(1, n * 5 + DAY), pages(1, n * 5 + 2 * DAY)])
        begun = time.perf_counter()
        out = run(jobs.user_jumps(page_stream(spark, folder), ["mid", "ms"]), f"many{n}", root)
        seconds[n] = time.perf_counter() - begun
        # Of each three pages the entry is followed by a page from inside; only entries a day apart are bounces.
        assert rows(spark.read.parquet(out), ["mid", "ms"]) <= Counter({("hot", NOON + (n - 1) * 5): 1, ("hot", NOON + n * 5 + DAY): 1})
    assert seconds[20_000] < 4 * seconds[5_000] + 10


def test_new_visitor_state(spark, root, page_folder):
    stream = keyed.repair_new_visitor(page_stream(spark, page_folder), "mid", "is_new", "ts", ["mid", "ms"])
    out = run(stream, "w1", root)
    batch = page_batch(spark, page_folder)
    expected = logs.repair_new_visitor(
        batch, F.col("mid"), F.col("is_new"), F.col("ts").cast("date"), ["ms"]
    ).select("mid", "ms", "repaired_is_new")
    assert rows(spark.read.parquet(out), ["mid", "ms", "repaired_is_new"]) == rows(expected)


def test_users_per_day(spark, root, page_folder):
    firsts = run(jobs.daily_users(page_stream(spark, page_folder), "mid", "ts"), "user-days", root, mode="update")
    expected = visits.daily_users(page_batch(spark, page_folder), "mid", "ts")
    assert rows(spark.read.parquet(firsts), ["user", "ts"]) == rows(expected, ["mid", "ts"])
    out = run(jobs.paying_users(day_stream(spark, firsts)), "pay-users", root)
    expected = visits.paying_users(page_batch(spark, page_folder), "mid", "ts")
    assert rows(spark.read.parquet(out), ["ts", "unique_user", "new_user"]) == rows(expected)


def test_traffic_rollup_over_stored_visits(spark, root, page_folder):
    """Pages, visitors and bounces are stored by their own jobs and rolled up by another."""
    pages_out = run(page_stream(spark, page_folder), "tr-pages", root)
    uv_out = run(jobs.unique_visitors(page_stream(spark, page_folder), KEEP), "tr-uv", root, mode="update")
    uj_out = run(jobs.user_jumps(page_stream(spark, page_folder), KEEP), "tr-uj", root)

    def stored(path):
        schema = spark.read.parquet(path).drop("batch").schema
        return stored_rows(spark, f"{path}/batch=*", schema, stream=True)

    traffic = windows.traffic_rows(stored(pages_out), stored(uv_out), stored(uj_out))
    out = run(windows.traffic_rollup(jobs.watermarked(traffic, delay=jobs.ROLLUP_DELAY)), "rollup", root)
    batch = page_batch(spark, page_folder)
    expected = windows.traffic_rollup(windows.traffic_rows(
        batch, visits.unique_visitors(batch), visits.user_jumps(batch)
    )).filter("stt < '2022-04-15'")
    columns = schemas.WINDOW_RESULTS["traffic"]
    assert rows(spark.read.parquet(out), columns) == rows(expected, columns)


def test_traffic_in_one_query(spark, root, page_folder):
    """Keyed state and the window aggregate in one plan; nothing is stored in between, and a restart adds nothing."""
    stream = jobs.traffic(page_stream(spark, page_folder))
    out = run(stream, "traffic-one", root)
    run(jobs.traffic(page_stream(spark, page_folder)), "traffic-one", root)
    batch = page_batch(spark, page_folder)
    expected = windows.traffic_rollup(windows.traffic_rows(
        batch, visits.unique_visitors(batch), visits.user_jumps(batch))).filter("stt < '2022-04-15'")
    columns = schemas.WINDOW_RESULTS["traffic"]
    got = rows(spark.read.parquet(out).filter("stt < '2022-04-15'"), columns)
    assert got == rows(expected, columns)
    assert sum(r[columns.index("ujCt")] * n for r, n in got.items()) > 10


def test_traffic_with_other_spans_and_windows(spark, root, page_folder):
    """Windows that the span does not fill evenly lie where they lie in batch."""
    out = run(jobs.traffic(page_stream(spark, page_folder), 7, "4 seconds"), "traffic-7", root)
    batch = page_batch(spark, page_folder)
    expected = windows.traffic_rollup(windows.traffic_rows(
        batch, visits.unique_visitors(batch), visits.user_jumps(batch, span_seconds=7)), width="4 seconds")
    columns = schemas.WINDOW_RESULTS["traffic"]
    before = "stt < '2022-04-15'"
    assert rows(spark.read.parquet(out).filter(before), columns) == rows(expected.filter(before), columns)


def test_keyword_window(spark, root):
    lines = [json.dumps({"item": w, "ms": NOON + i * 3000}) for i, w in enumerate(
        ["red shoe", "shoe", "Shoe 42", "hat", "red hat"])]
    folder = put_files(root / "words", [lines[:3], lines[3:], [json.dumps({"item": "x", "ms": NOON + DAY})]])

    def searches(stream):
        rows_ = file_lines(spark, folder, stream).select(
            F.from_json("value", "item STRING, ms BIGINT").alias("r")).select("r.*")
        pages = rows_.select(
            F.struct(F.lit("search").alias("last_page_id"), F.lit("keyword").alias("item_type"), "item")
            .alias("page"), F.timestamp_millis("ms").alias("ts"))
        found = plan_windows.search_keywords(pages)
        return jobs.watermarked(found) if stream else found

    out = run(windows.keyword_counts(explode_words(searches(True), "item")), "keywords", root)
    expected = windows.keyword_counts(explode_words(searches(False), "item")).filter("keyword <> 'x'")
    columns = schemas.WINDOW_RESULTS["keyword"]
    assert rows(spark.read.parquet(out), columns) == rows(expected, columns)


DETAIL_SCHEMA = (
    "id STRING, order_id STRING, user_id STRING, province_id STRING, sku_id STRING, sku_num STRING,"
    " order_price STRING, split_activity_amount STRING, split_coupon_amount STRING,"
    " split_total_amount STRING, ms BIGINT"
)


@pytest.fixture(scope="module")
def detail_folder(root):
    rng = random.Random(2)
    lines = []
    for i in range(160):
        price = f"{rng.randrange(100, 9999) / 100:.2f}"
        lines.append(json.dumps({
            "id": str(i), "order_id": f"o{i // 3}", "user_id": "hot" if rng.random() < .4 else f"u{i % 5}",
            "province_id": rng.choice("12"), "sku_id": rng.choice("ab"), "sku_num": str(rng.randrange(1, 4)),
            "order_price": price, "split_activity_amount": rng.choice([None, "1.25"]),
            "split_total_amount": price, "ms": NOON + i * 700}))
        if i % 4 == 0:
            lines.append(lines[-1])  # sent twice
    flush = json.dumps({"id": "flush", "order_id": "f", "user_id": "f", "province_id": "9", "sku_num": "1",
                        "order_price": "1", "split_total_amount": "1", "ms": NOON + 30 * DAY})
    return put_files(root / "details", [lines[:70], lines[70:140], lines[140:], [flush]])


def detail_rows(spark, folder, stream):
    lines = file_lines(spark, folder, stream, 1)
    return lines.select(F.from_json("value", DETAIL_SCHEMA).alias("r")).select("r.*").withColumn(
        "ts", F.timestamp_millis("ms"))


def test_province_window_with_dedup_in_one_stream(spark, root, detail_folder):
    provinces = spark.createDataFrame([("1", "one"), ("2", "two")], "id STRING, name STRING")
    deduplicated = jobs.first_details(detail_rows(spark, detail_folder, True))
    out = run(windows.province_order_window(deduplicated, provinces), "province", root)
    batch = keep_first(detail_rows(spark, detail_folder, False), "id", ["ms"])
    expected = windows.province_order_window(batch, provinces).filter("provinceId <> '9'")
    columns = schemas.WINDOW_RESULTS["province_order"]
    assert rows(spark.read.parquet(out), columns) == rows(expected, columns)


def test_order_window_from_two_streams(spark, root, detail_folder):
    deduplicated = run(jobs.first_details(detail_rows(spark, detail_folder, True)), "ow-details", root)

    def stored(path):
        schema = spark.read.parquet(path).drop("batch").schema
        return stored_rows(spark, f"{path}/batch=*", schema, stream=True)

    days = run(jobs.daily_users(stored(deduplicated), "user_id", "ts"), "ow-days", root, mode="update")
    users = run(jobs.paying_users(day_stream(spark, days)), "ow-users", root)
    rows_ = jobs.order_rows(stored(deduplicated), stored(users))
    out = run(jobs.order_window(jobs.watermarked(rows_)), "ow", root)
    batch = keep_first(detail_rows(spark, detail_folder, False), "id", ["ms"])
    expected = windows.order_window(batch).filter("stt < '2022-04-20'")
    columns = schemas.WINDOW_RESULTS["order"]
    assert rows(spark.read.parquet(out), columns) == rows(expected, columns)


def test_product_windows(spark, root, detail_folder):
    """Lookup before, names after two chained aggregations, in one stream."""
    def dim(columns, *rows_):
        return spark.createDataFrame(list(rows_), columns)

    products = plan_windows.ProductDimensions(
        sku=dim("id STRING, spu_id STRING, tm_id STRING, category3_id STRING", ("a", "p", "t", "c3")),
        spu=dim("id STRING, spu_name STRING", ("p", "spu")),
        trademark=dim("id STRING, tm_name STRING", ("t", "tm")),
        category3=dim("id STRING, name STRING, category2_id STRING", ("c3", "three", "c2")),
        category2=dim("id STRING, name STRING, category1_id STRING", ("c2", "two", "c1")),
        category1=dim("id STRING, name STRING", ("c1", "one")),
    )
    for name, build, result in (
        ("spu", plan_windows.user_spu_order_window, "user_spu_order"),
        ("refunds", plan_windows.refund_window, "refund"),
    ):
        out = run(build(jobs.first_details(detail_rows(spark, detail_folder, True)), products), name, root)
        batch = keep_first(detail_rows(spark, detail_folder, False), "id", ["ms"])
        expected = build(batch, products).filter("userId <> 'f'")
        columns = schemas.WINDOW_RESULTS[result]
        assert rows(spark.read.parquet(out), columns) == rows(expected, columns)
        assert expected.filter("category1Name = 'one'").count() > 0
        assert expected.filter("trademarkId is null").count() > 0


def test_cart_jobs(spark, root, dic):
    def cart(i, user, second, operate=None):
        data = {"id": str(i), "user_id": user, "sku_num": "1", "source_type": "2401",
                "create_time": f"2022-04-01 12:00:{second:02d}"}
        return change("cart_info", "insert", {**data, **({"operate_time": operate} if operate else {})}, second)

    folder = put_files(root / "carts", [
        [cart(1, "u", 1), cart(2, "u", 2), cart(3, "v", 3)],
        [cart(4, "u", 4, "2022-04-02 00:00:01"), cart(5, "w", 5)],
        [cart(9, "z", 6, "2022-05-01 00:00:00")]])

    def carts(stream):
        return facts.cart_add(change_rows(spark, folder, stream), dic, "shop")

    users = run(jobs.cart_users(carts(True)), "cart-u", root, mode="update")
    stored = stored_rows(spark, f"{users}/batch=*", "user STRING, ts TIMESTAMP", stream=True)
    out = run(windows.cart_window(jobs.watermarked(stored)), "cart-w", root)
    timed = plan_windows.cart_event_time(carts(False))
    expected = windows.cart_window(visits.daily_users(timed, "user_id", "ts")).filter("stt < '2022-05'")
    columns = schemas.WINDOW_RESULTS["cart_add"]
    assert rows(spark.read.parquet(out), columns) == rows(expected, columns)
    assert sorted(r["cartAddUuCt"] for r in expected.collect()) == [1, 3]


def test_payment_and_register_jobs(spark, root):
    lines = [json.dumps({"user_id": u, "callback_time": t}) for u, t in [
        ("u", "2022-04-01 12:00:01"), ("u", "2022-04-01 12:00:02"), ("v", "2022-04-01 12:00:03"),
        ("u", "2022-04-02 12:00:01"), ("z", "2022-05-01 12:00:00")]]
    folder = put_files(root / "paid", [lines[:2], lines[2:4], lines[4:]])

    def paid(stream):
        return file_lines(spark, folder, stream, 1).select(
            F.from_json("value", "user_id STRING, callback_time STRING").alias("r")).select("r.*")

    days = run(jobs.payment_users(paid(True)), "paid-d", root, mode="update")
    users = run(jobs.paying_users(day_stream(spark, days)), "paid-u", root)
    stored = stored_rows(
        spark, f"{users}/batch=*", "ts TIMESTAMP, unique_user BIGINT, new_user BIGINT", stream=True)
    out = run(windows.payment_window(jobs.watermarked(stored)), "paid-w", root)
    got = sorted(tuple(r) for r in spark.read.parquet(out).drop("batch").collect())
    assert got == [("2022-04-01 12:00:00", "2022-04-01 12:00:10", 2, 2),
                   ("2022-04-02 12:00:00", "2022-04-02 12:00:10", 1, 0)]
    registered = jobs.watermarked(jobs.text_time(paid(True), "callback_time"))
    out = run(windows.register_window(registered), "reg-w", root)
    got = sorted((r["stt"], r["registerCt"]) for r in spark.read.parquet(out).collect())
    assert got == [("2022-04-01 12:00:00", 3), ("2022-04-02 12:00:00", 1)]


def test_late_rows_are_dropped(spark, root):
    def line(ms):
        return json.dumps({"id": str(ms), "ms": ms})

    folder = put_files(root / "lateness", [
        # a batch is judged by the watermark that the batches before its predecessor set
        [line(NOON)], [line(NOON + 60_000)], [line(NOON + 61_000)], [line(NOON + 1)], [line(NOON + DAY)]])
    df = file_lines(spark, folder, True, 1).select(F.from_json("value", "id STRING, ms BIGINT").alias("r"))
    df = df.select("r.*").withColumn("ts", F.timestamp_millis("ms"))
    out = run(windows.register_window(jobs.watermarked(df)), "lateness", root)
    got = sorted((r["stt"], r["registerCt"]) for r in spark.read.parquet(out).collect())
    assert got == [("2022-04-01 12:00:00", 1), ("2022-04-01 12:01:00", 2)]


def versions(spark, folder):
    return file_lines(spark, folder, True, 1).select(
        F.from_json("value", "id STRING, v STRING, version BIGINT").alias("r")).select("r.*").withColumn(
        "row_op_ts", F.timestamp_millis("version"))


def version_line(v, version, key="1"):
    return json.dumps({"id": key, "v": v, **({} if version is None else {"version": version})})


def test_keep_latest_holds_and_sends_once(spark, root):
    folder = put_files(root / "versions", [
        [version_line("a", 1000), version_line("c", 3000), version_line("n", None, "2")], [version_line("b", 2000)],
        [version_line("d", 3000), version_line("m", None, "2")]])
    # the hold outlasts the files, so the older version that comes later cannot win; of equal ones the later arrival does
    latest = keyed.keep_latest(versions(spark, folder), "id", "row_op_ts", ["id", "v"], hold_millis=25_000)
    out = str(root / "out-latest")
    jobs.drain(jobs.start(latest, "latest", jobs.table_writer(out), every="500 milliseconds"), seconds=120)
    assert rows(spark.read.parquet(out), ["id", "v"]) == {("1", "d"): 1, ("2", "m"): 1}


def test_held_rows_outlive_a_stop(spark, root):
    """One batch, then the query is gone; what it held is sent after the next start, newer versions included."""
    folder = put_files(root / "stopped", [[version_line("a", 1000)]])
    out = str(root / "out-stopped")

    def start():
        latest = keyed.keep_latest(versions(spark, folder), "id", "row_op_ts", ["id", "v"], hold_millis=15_000)
        return jobs.start(latest, "stopped", jobs.table_writer(out), every="500 milliseconds")

    query = start()
    deadline = time.monotonic() + 60
    while time.monotonic() < deadline and not (query.lastProgress and query.lastProgress["stateOperators"][0]["numRowsTotal"]):
        time.sleep(0.2)
    query.stop()
    assert not rows(spark.read.schema("id string, v string").parquet(out))
    (root / "stopped" / "0001.txt").write_text(version_line("b", 2000) + "\n", encoding="utf-8")
    jobs.drain(start(), seconds=120)
    assert rows(spark.read.parquet(out), ["id", "v"]) == {("1", "b"): 1}


def change(table, kind, data, second, old=None):
    return json.dumps({"database": "shop", "table": table, "type": kind, "data": data, "old": old,
                       "ts": str(NOON // 1000 + second)})


@pytest.fixture(scope="module")
def change_folder(root):
    chunks = []
    for o in range(6):
        t = o * 10
        lines = [change("order_info", "insert", {"id": f"o{o}", "order_status": "1001", "user_id": "u"}, t)]
        for d in range(3):
            key = f"d{o}{d}"
            lines.append(change("order_detail", "insert", {
                "id": key, "order_id": f"o{o}", "sku_id": f"s{d}", "split_total_amount": "1.50",
                "source_type": "2401" if d else "2402"}, t + 1))
            if d == 1:
                lines.append(change("order_detail_activity", "insert",
                                    {"id": "a" + key, "order_id": f"o{o}", "order_detail_id": key, "activity_id": "7"}, t + 1))
        lines.append(change("order_info", "update", {"id": f"o{o}", "order_status": "1003", "operate_time": "t"},
                            t + 3, {"order_status": "1001"}))
        lines.append(change("payment_info", "update", {
            "order_id": f"o{o}", "payment_type": "1101", "payment_status": "1602"}, t + 4))
        # too late for the order join's bound
        lines.append(change("order_info", "update", {"id": f"o{o}", "order_status": "1002"}, t + 8,
                            {"order_status": "1001"}))
        lines.append(change("order_refund_info", "insert", {
            "id": f"r{o}", "order_id": f"o{o}", "sku_id": "s1", "refund_type": "1501",
            "refund_reason_type": "1301", "refund_num": "1"}, t + 8))
        lines.append(change("order_info", "update", {"id": f"o{o}", "order_status": "1005", "province_id": "3"},
                            t + 9, {"order_status": "1002"}))
        lines.append(change("refund_payment", "insert", {
            "id": f"p{o}", "order_id": f"o{o}", "sku_id": "s1", "payment_type": "1101"}, t + 9))
        lines.append(change("order_info", "update", {"id": f"o{o}", "order_status": "1006", "user_id": "u"},
                            t + 9, {"order_status": "1005"}))
        chunks.append(lines)
    flush = [change(t, "insert", {"id": "f", "order_id": "f", "order_detail_id": "f"}, 9000) for t in
             ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon", "payment_info",
              "order_refund_info", "refund_payment")]
    return put_files(root / "changes", [*chunks, flush, flush])


@pytest.fixture(scope="module")
def dic(spark):
    return spark.createDataFrame(
        [("2401", "search"), ("1101", "card"), ("1501", "money"), ("1301", "broken")],
        "dic_code STRING, dic_name STRING")


def change_rows(spark, folder, stream):
    return changelog_rows(file_lines(spark, folder, stream, 1))


def test_order_wide_stream(spark, root, change_folder, dic):
    stream = joins.order_wide(joins.with_event_time(change_rows(spark, change_folder, True)), dic, "shop")
    out = run(stream, "wide", root)
    columns = ["id", "type", "order_status", "activity_id", "coupon_id", "source_type_name"]
    got = rows(spark.read.parquet(out), columns)
    batch = facts.order_wide(change_rows(spark, change_folder, False), dic, "shop")
    expected = rows(batch.filter("order_status in ('1001', '1003')"), columns)
    assert got == expected and sum(got.values()) == 24


def test_pay_and_refund_streams(spark, root, change_folder, dic):
    changes = joins.with_event_time(change_rows(spark, change_folder, True))
    details = facts.order_details(changes, "shop", [joins.EVENT_TIME]).withColumnsRenamed(
        {"source_type": "source_type_id"}
    ).withColumns({c: F.lit(None).cast("string") for c in (
        "user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id", "source_type_name")})
    out = run(joins.pay_detail(changes, details, dic), "pay", root)
    got = rows(spark.read.parquet(out), ["order_detail_id", "payment_type_name"])
    assert got == Counter({(f"d{o}{d}", "card"): 1 for o in range(6) for d in range(3)})

    out = run(joins.order_refund(joins.with_event_time(change_rows(spark, change_folder, True)), dic), "rf", root)
    columns = ["id", "refund_type_name", "refund_reason_type_name", "province_id"]
    batch = facts.order_refund(change_rows(spark, change_folder, False), dic)
    assert rows(spark.read.parquet(out), columns) == rows(batch, columns)

    out = run(joins.refund_paid(joins.with_event_time(change_rows(spark, change_folder, True)), dic), "rp", root)
    columns = ["id", "user_id", "sku_id", "payment_type_name", "refund_num"]
    batch = facts.refund_paid(change_rows(spark, change_folder, False), dic)
    assert rows(spark.read.parquet(out), columns) == rows(batch, columns)
    assert batch.count() == 6


WIDE_TABLES = ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon")
WIDE_COLUMNS = ["id", "type", "order_status", "activity_id", "coupon_id", "source_type_name"]


def copy_files(source, folder, names):
    folder.mkdir(exist_ok=True)
    for name in names:
        (folder / name).write_text((Path(source) / name).read_text(encoding="utf-8"), encoding="utf-8")
        stamp = 1_600_000_000 + int(name[:4])
        os.utime(folder / name, (stamp, stamp))


def test_partners_hours_apart_are_completed(spark, root, change_folder, dic):
    """The stream gives what lies within five seconds; completions give the rest, and in the end the batch form."""
    folder = root / "hours"
    copy_files(change_folder, folder, ["0000.txt", "0001.txt"])
    store = ChangeStore(str(root / "hours-changes"))
    fact = CompletedFact(str(root / "hours-wide"), store, lambda rows_: facts.order_wide(rows_, dic, "shop"), WIDE_TABLES,
                         ("order_detail_activity_id", "activity_id", "activity_rule_id", "order_detail_coupon_id", "coupon_id",
                          "coupon_use_id"))

    def turn():
        run(change_rows(spark, str(folder), True), "hours-store", root, store.writer())
        early = joins.order_wide(joins.with_event_time(change_rows(spark, str(folder), True)), dic, "shop").drop(joins.EVENT_TIME)
        run(early, "hours-early", root, fact.writer())

    def expected():
        return rows(facts.order_wide(change_rows(spark, str(folder), False), dic, "shop"), WIDE_COLUMNS)

    turn()
    before = rows(fact.read(spark), WIDE_COLUMNS)
    assert fact.complete(spark) and not fact.complete(spark)
    assert rows(fact.read(spark), WIDE_COLUMNS) == expected() and sum(before.values()) < sum(expected().values())
    copy_files(change_folder, folder, ["0002.txt", "0003.txt"])
    # A cancel, an activity and a coupon six hours after their order, and an order before its details.
    late = [change("order_info", "update", {"id": "o0", "order_status": "1003", "operate_time": "late"}, 6 * 3600, {"order_status": "1002"}),
            change("order_detail_coupon", "insert", {"id": "c1", "order_id": "o0", "order_detail_id": "d01", "coupon_id": "9"}, 6 * 3600),
            change("order_detail_activity", "insert", {"id": "b1", "order_id": "o1", "order_detail_id": "d12", "activity_id": "8"}, 6 * 3600)]
    (folder / "0004.txt").write_text("\n".join(late) + "\n", encoding="utf-8")
    turn()
    assert sum(rows(fact.read(spark), WIDE_COLUMNS).values()) > sum(before.values())
    assert fact.complete(spark)
    assert rows(fact.read(spark), WIDE_COLUMNS) == expected()
    fact.fold(spark)
    assert rows(fact.read(spark), WIDE_COLUMNS) == expected()
    got = {r["id"]: r["coupon_id"] for r in fact.read(spark).filter("order_id = 'o0' and operate_time = 'late'").collect()}
    assert got == {"d01": "9", "d02": None}


def test_paid_details_and_refunds_hours_apart(spark, root, dic):
    """Payment, refund request and refund payment of one order, each hours after the one before."""
    hour = 3600
    lines = [change("order_info", "insert", {"id": "o", "order_status": "1001", "user_id": "u"}, 0),
             change("order_detail", "insert", {"id": "d", "order_id": "o", "sku_id": "s", "source_type": "2401"}, 1),
             change("payment_info", "update", {"order_id": "o", "payment_type": "1101", "payment_status": "1602"}, 2 * hour),
             change("order_info", "update", {"id": "o", "order_status": "1005", "province_id": "3"}, 5 * hour, {"order_status": "1002"}),
             change("order_refund_info", "insert", {"id": "r", "order_id": "o", "sku_id": "s", "refund_type": "1501",
                                                    "refund_reason_type": "1301", "refund_num": "1"}, 6 * hour),
             change("refund_payment", "insert", {"id": "p", "order_id": "o", "sku_id": "s", "payment_type": "1101"}, 9 * hour),
             change("order_info", "update", {"id": "o", "order_status": "1006", "user_id": "u"}, 12 * hour, {"order_status": "1005"})]
    folder = put_files(root / "paid-late", [[line] for line in lines])
    store = ChangeStore(str(root / "paid-late-changes"))

    def pay(rows_):
        return facts.pay_detail(rows_, facts.order_detail(facts.order_wide(rows_, dic)), dic)

    built = {"pay": (pay, (*WIDE_TABLES, "payment_info")),
             "refund": (lambda rows_: facts.order_refund(rows_, dic), ("order_info", "order_refund_info")),
             "paid": (lambda rows_: facts.refund_paid(rows_, dic), ("order_info", "order_refund_info", "refund_payment"))}
    completed = {name: CompletedFact(str(root / f"paid-late-{name}"), store, build, tables) for name, (build, tables) in built.items()}

    def write(changes, batch_id):
        store.writer()(changes, batch_id)
        for fact in completed.values():
            fact.complete(spark)

    run(change_rows(spark, folder, True), "paid-late", root, write)
    for name, (build, _) in built.items():
        whole = build(change_rows(spark, folder, False))
        assert rows(completed[name].read(spark)) == rows(whole) and whole.count() == 1


def test_left_join_is_taken_back_when_the_partner_comes(spark, root):
    """Details at once without activity; the row without is taken back when one or two activities come, and a repeated
    batch or a fold changes nothing."""
    def detail(i, second):
        return change("order_detail", "insert", {"id": i, "order_id": "o"}, second)

    def activity(i, of, second):
        return change("order_detail_activity", "insert", {"id": i, "order_detail_id": of, "activity_id": "x" + i}, second)

    folder = put_files(root / "taken-back", [
        [detail("1", 0), detail("2", 0), detail("3", 0)], [activity("a", "1", 1)], [activity("b", "1", 2), activity("c", "2", 2)],
        [activity("e", "4", 3), detail("4", 3)]])

    def sides(stream):
        changes = joins.with_event_time(change_rows(spark, folder, stream))
        return (facts.order_details(changes, "shop", [joins.EVENT_TIME]).select("id", joins.EVENT_TIME),
                facts.order_activities(changes, "shop", [joins.EVENT_TIME]))

    table = keyed_table(str(root / "taken-back-table"), ["id", "order_detail_activity_id"], joins.VERSION, versioned=True,
                        deleted=joins.DELETED)
    seen = []

    def write(df, batch_id):
        table.merge(df, batch_id)
        seen.append(rows(table.read(spark), ["id", "activity_id"]))
        table.merge(df, batch_id)
        if batch_id == 1:
            table.compact(spark, keep_deletes=True)

    run(joins.changelog_left_join(*sides(True), ["id"], joins.ORDER_BOUND, "order_detail_activity_id"), "taken-back", root, write)
    assert seen[0] == Counter([("1", None), ("2", None), ("3", None)])
    left, right = sides(False)
    expected = rows(left.join(right.drop(joins.EVENT_TIME), "id", "left"), ["id", "activity_id"])
    assert rows(table.read(spark), ["id", "activity_id"]) == expected == Counter(
        [("1", "xa"), ("1", "xb"), ("2", "xc"), ("3", None), ("4", "xe")])
    table.compact(spark)
    assert rows(table.read(spark), ["id", "activity_id"]) == expected


def test_codes_added_while_a_stateful_fact_runs_are_found(spark, root):
    """Codes of order details and payments that come into the dictionary between two batches of the same queries."""
    folder = root / "stateful-codes"
    folder.mkdir()

    def order(o, second):
        return [change("order_info", "insert", {"id": f"o{o}", "order_status": "1001", "user_id": "u"}, second),
                change("order_detail", "insert", {"id": f"d{o}", "order_id": f"o{o}", "source_type": f"240{o}"}, second),
                change("payment_info", "update", {"order_id": f"o{o}", "payment_type": f"110{o}", "payment_status": "1602"}, second),
                *[change(t, "insert", {"id": "f", "order_detail_id": "f"}, second + 60)
                  for t in ("order_detail_activity", "order_detail_coupon")],
                change("order_info", "insert", {"id": f"f{o}"}, second + 60), change("order_detail", "insert", {"id": f"f{o}"}, second + 60)]

    def put(number, lines):
        (folder / f"000{number}.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")

    dictionary = str(root / "stateful-dictionary")
    shape = "dic_code STRING, dic_name STRING"
    spark.createDataFrame([("2401", "one"), ("1101", "card")], shape).write.parquet(dictionary)
    put(1, order(1, 0))

    def frames():
        changes = joins.with_event_time(change_rows(spark, str(folder), True))
        details = facts.order_details(changes, "shop", [joins.EVENT_TIME]).withColumnRenamed(
            "source_type", "source_type_id").withColumns({c: F.lit(None).cast("string") for c in (
                "user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id", "source_type_name")})
        return {"order_wide": joins.order_wide(changes, None, "shop"), "pay_detail": joins.pay_detail(changes, details, None, "shop")}

    def turn():
        for name, frame in frames().items():
            writer = jobs.dictionary_writer(
                lambda rows_, dic_, n=name: lookup.name_codes(rows_, dic_, joins.NAMES[n]), lambda: spark.read.parquet(dictionary),
                jobs.table_writer(str(root / f"named-{name}")))
            run(frame, f"named-{name}", root, writer)

    turn()
    spark.createDataFrame([("2402", "two"), ("1102", "cash")], shape).write.mode("append").parquet(dictionary)
    put(2, order(2, 1000))
    put(3, order(9, 2000))
    turn()
    wide = rows(spark.read.parquet(str(root / "named-order_wide")).filter("order_id like 'o%'"), ["id", "source_type_name"])
    assert wide == Counter([("d1", "one"), ("d2", "two")])
    paid = rows(spark.read.parquet(str(root / "named-pay_detail")), ["order_detail_id", "source_type_name", "payment_type_name"])
    assert paid == Counter([("d1", "one", "card"), ("d2", "two", "cash")])


def test_log_splitter(spark, root):
    def record(mid, is_new, ms, **extra):
        return json.dumps({"common": {"mid": mid, "is_new": is_new}, "page": {"page_id": "home"}, "ts": ms, **extra})

    folder = put_files(root / "logs", [
        [record("a", "1", NOON), record("b", "0", NOON), "junk"],
        [record("a", "1", NOON + DAY, err={"c": 1}), record("b", "1", NOON), record("c", "1", NOON + DAY)],
        [record("c", "1", NOON + DAY + 5, actions=[{"action_id": "x"}], displays=[{"item": "1"}, {"item": "2"}]),
         record("c", "1", NOON + 2 * DAY, start={"entry": "icon"})],
    ])
    outputs = root / "split"
    first_visits = jobs.first_visit_table(str(root / "first"))
    writer = jobs.log_splitter(first_visits, str(outputs))
    run(file_lines(spark, folder, True, 1), "split", root, writer)

    def read(name):
        return spark.read.text(str(outputs / name)).select("value").collect()

    assert [r["value"] for r in read("dirty")] == ["junk"]
    pages = Counter((p["common"]["mid"], p["common"]["is_new"], p["ts"])
                    for p in (json.loads(r["value"]) for r in read("page")))
    assert pages == Counter([
        ("a", "1", NOON), ("b", "0", NOON), ("a", "0", NOON + DAY), ("b", "0", NOON), ("c", "1", NOON + DAY),
        ("c", "1", NOON + DAY + 5)])
    assert [json.loads(r["value"])["common"]["is_new"] for r in read("start")] == ["0"]
    assert len(read("error")) == 1 and len(read("action")) == 1 and len(read("display")) == 2
    # a repeated batch replaces its own rows, before and after the first visits were folded
    for number in (1, 2):
        writer(spark.read.text(f"{folder}/000{number}.txt"), number)
        again = Counter((p["common"]["mid"], p["common"]["is_new"], p["ts"])
                        for p in (json.loads(r["value"]) for r in read("page")))
        assert again == pages
        first_visits.compact(spark)
    assert sorted(r["mid"] for r in first_visits.read(spark).collect()) == ["a", "b", "c"]


def test_dimension_stream_and_compaction(spark, root):
    def row(i, name, kind, ts):
        return json.dumps({"database": "shop", "table": "sku", "type": kind, "data": {"id": i, "name": name, "x": "y"},
                           "ts": ts})

    folder = put_files(root / "dims", [
        [row("1", "a", "insert", "9"), row("2", "b", "insert", "9"), row("2", "b2", "update", "10")],
        [row("1", "c", "update", "11"), row("3", "d", "bootstrap-insert", "11")],
        [row("2", "e", "update", "12"), row(None, "f", "insert", "12"), row(None, "g", "insert", "12")]])
    config = root / "config"
    config.mkdir()
    (config / "rules.json").write_text(json.dumps(
        {"sourceTable": "sku", "sinkTable": "dim_sku", "sinkColumns": "id,name"}))
    table = jobs.dimension_store(str(root / "dim-table"))
    writer = jobs.dimension_writer(lambda: dimension_config(spark, str(config)), table)
    run(change_rows(spark, folder, True), "dims", root, writer)

    def current():
        return sorted((r["pk"], r["data"]["name"]) for r in table.read(spark).collect())

    expected = [("1", "c"), ("2", "e"), ("3", "d")]
    assert current() == expected
    rejected = spark.read.parquet(f"{table.root}/rejected")
    assert sorted(r["data"]["name"] for r in rejected.collect()) == ["f", "g"]
    table.compact(spark)
    assert current() == expected
    writer(spark.read.text(f"{folder}/0002.txt").transform(changelog_rows), 3)
    assert current() == expected


def test_a_code_added_while_the_stream_runs_is_found(spark, root):
    folder = root / "codes"
    put_files(folder, [["a"]])
    dictionary = str(root / "code-table")
    spark.createDataFrame([("a", "one")], "dic_code STRING, dic_name STRING").write.parquet(dictionary)
    out = str(root / "coded")
    writer = jobs.dictionary_writer(
        lambda lines, dic: lookup.dictionary_join(lines, dic, "value", "name"),
        lambda: spark.read.parquet(dictionary), jobs.table_writer(out))
    query = jobs.start(file_lines(spark, str(folder), stream=True), "codes", writer, every="0 seconds")
    try:
        query.processAllAvailable()
        spark.createDataFrame([("b", "two")], "dic_code STRING, dic_name STRING").write.mode("append").parquet(dictionary)
        (folder / "0001.txt").write_text("b\n", encoding="utf-8")
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark.read.parquet(out), ["value", "name"]) == {("a", "one"): 1, ("b", "two"): 1}


def test_stored_table_gives_each_row_once_after_a_repeated_batch(spark, root):
    """The commit of the upstream's last batch is lost, as if it had died there; it starts again after its reader."""
    folder = root / "chained"
    put_files(folder, [["a", "b"], ["c"]])
    table, out = str(root / "chained-table"), str(root / "chained-out")

    def upstream():
        query = jobs.store(file_lines(spark, str(folder), stream=True), "chained-up", table)
        query.awaitTermination()

    def downstream():
        run(stored_rows(spark, table, "value STRING", stream=True), "chained-down", root, jobs.table_writer(out))

    upstream()
    downstream()
    commits = Path(checkpoint_root(spark)) / "chained-up" / "commits"
    newest = max((c for c in commits.iterdir() if c.name.isdigit()), key=lambda c: int(c.name))
    for lost in (newest, commits / f".{newest.name}.crc"):
        lost.unlink(missing_ok=True)
    upstream()
    downstream()
    assert rows(spark.read.parquet(out), ["value"]) == {("a",): 1, ("b",): 1, ("c",): 1}
