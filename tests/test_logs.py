from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from retailflow.operators import logs

DAY = 24 * 3600 * 1000
NOON = 1648785600000  # 2022-04-01 12:00:00 +08:00


def record(mid="m1", is_new="1", ts=NOON, **extra):
    base = {
        "common": {"mid": mid, "uid": "u", "vc": "v", "ch": "c", "ar": "a", "is_new": is_new},
        "page": {"page_id": "home", "last_page_id": None, "during_time": 7},
        "ts": ts,
    }
    base.update(extra)
    return json.dumps({k: v for k, v in base.items() if v is not None})


def parse(spark, lines):
    return logs.parse_logs(spark.createDataFrame([(x,) for x in lines], "value STRING"))


def shop_day():
    return F.timestamp_millis("ts").cast("date")


def test_dirty_text(spark):
    good = record()
    bad = ["", "   ", "not json", good[:-5], good + " trailing", "[1]", "null", None,
           good + " trailing}", good + good, good + "," + good, good + "]}", "1"]
    parsed = parse(spark, [good, f"  {good}\n", *bad])
    assert sorted(r["value"] or "" for r in logs.dirty_lines(parsed).collect()) == sorted(
        x or "" for x in bad
    )
    assert logs.clean_logs(parsed).count() == 2


def test_outputs(spark):
    lines = [
        record(start={"entry": "icon"}, err={"error_code": 1}),
        record(err={"error_code": 2}, displays=[{"item": 1, "pos_id": 1}, {"item": 2, "pos_id": 2}]),
        record(displays=[], actions=[{"action_id": "cart_add", "item": 3, "ts": NOON + 5}]),
        record(page=None, err={"error_code": 3}),
    ]
    out = logs.split_logs(logs.clean_logs(parse(spark, lines)))
    assert out["error"].count() == 3
    assert [r["start"] for r in out["start"].collect()] == ['{"entry":"icon"}']
    assert "err" not in out["start"].columns
    shown = out["display"].orderBy(F.col("display")["pos_id"]).collect()
    assert [(r["display"]["item"], r["page_id"], r["ts"]) for r in shown] == [
        ("1", "home", NOON), ("2", "home", NOON)]
    acts = out["action"].collect()
    assert [(r["action"]["ts"], r["common"]["mid"]) for r in acts] == [(str(NOON + 5), "m1")]
    assert out["page"].count() == 2
    assert out["page"].columns == ["common", "page", "ts", "more"]


def test_records_of_unusual_types_stay_whole(spark):
    line = json.dumps({"common": {"mid": "m", "md": {"os": "x"}}, "page": {"page_id": "p", "during_time": "12", "n": 1.5},
                       "displays": {"item": 1}, "actions": "none", "ts": "1648785600000", "trace": [1, 2]})
    parsed = parse(spark, [line, line.replace('"12"', "12.5"), '{"ts":"soon","common":7}', "{}"])
    assert logs.dirty_lines(parsed).count() == 0
    rows = [r.asDict(recursive=True) for r in logs.clean_logs(parsed).orderBy(F.desc_nulls_last("ts")).collect()]
    for row in rows[:2]:
        assert (row["ts"], row["page"]["during_time"]) == (NOON, 12)
        assert row["common"]["more"] == {"md": '{"os":"x"}'}
        assert row["page"]["more"] == {"n": "1.5"}
        assert row["more"] == {"trace": "[1,2]"}
        assert row["displays"] is None
    assert [(r["ts"], r["common"]) for r in rows[2:]] == [(None, None)] * 2


def test_equal_times_do_not_decide_at_random(spark):
    lines = [record("a", "1", NOON), record("a", "0", NOON), record("a", "1", NOON + 5)]
    assert repair(spark, lines)[("a", NOON + 5)] == repair(spark, lines[::-1])[("a", NOON + 5)] == "0"


def repair(spark, lines):
    clean = logs.clean_logs(parse(spark, lines))
    rows = logs.repair_logs(clean, shop_day()).select("common.mid", "common.is_new", "ts").collect()
    return {(r["mid"], r["ts"]): r["is_new"] for r in rows}


def test_new_visitor_rules(spark):
    got = repair(spark, [
        record("a", "1", NOON), record("a", "1", NOON + 1), record("a", "1", NOON + DAY),
        record("b", "0", NOON), record("b", "1", NOON + 1),
        record("c", "1", NOON), record("c", "0", NOON + 1),
    ])
    assert got == {
        ("a", NOON): "1", ("a", NOON + 1): "1", ("a", NOON + DAY): "0",
        # first seen as a known visitor: the first day is the day before
        ("b", NOON): "0", ("b", NOON + 1): "0",
        ("c", NOON): "1", ("c", NOON + 1): "0",
    }


def test_new_visitor_repair_against_replay(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        # one device holds a third of all rows
        mid = "hot" if rng.random() < 0.34 else f"m{rng.randrange(30)}"
        rows.append((mid, rng.choice("01"), NOON + i * 3_600_000 + rng.randrange(1000)))
    first, expected = {}, {}
    for mid, is_new, ts in sorted(rows, key=lambda r: r[2]):
        day = (ts + 8 * 3_600_000) // DAY
        if mid not in first:
            first[mid] = day if is_new == "1" else day - 1
        expected[(mid, ts)] = "0" if is_new == "1" and day != first[mid] else is_new
    rng.shuffle(rows)
    assert repair(spark, [record(*r) for r in rows]) == expected
