"""Completions that touch some or all orders: which rows are read, and what is shuffled for it."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from retailflow import schemas
from retailflow.plans import facts
from retailflow.session import SHUFFLES_END
from retailflow.sinks.tables import write_batch
from retailflow.streaming import late
from retailflow.streaming.late import ChangeStore, CompletedFact
from retailflow.tables import inputs


@pytest.fixture
def stored(spark, tmp_path):
    store = ChangeStore(str(tmp_path / "changes"))

    def build(changes):
        return changes.groupBy(F.col("data")["order_id"].alias("order_id")).agg(F.sum(F.col("data")["n"].cast("int")).alias("n"))

    return store, CompletedFact(str(tmp_path / "fact"), store, build, ("order_detail",))


def send(spark, store, batch, pairs):
    rows = [("shop", "order_detail", "insert", {"order_id": o, "n": str(n)}, None, "0") for o, n in pairs]
    store.writer()(spark.createDataFrame(rows, "database string, table string, type string, data map<string,string>, "
                                               "old map<string,string>, ts string"), batch)


def read(spark, fact):
    return sorted((r["order_id"], r["n"]) for r in fact.read(spark).collect())


def test_orders_stay_where_they_were_last_touched(spark, stored):
    store, fact = stored
    send(spark, store, 0, [("a", 1), ("b", 2), ("c", 3), (None, 9)])
    assert fact.complete(spark)
    for batch, pairs, expected in [
        (1, [("b", 10)], [("a", 1), ("b", 12), ("c", 3)]),
        (2, [("a", 100), ("d", 4)], [("a", 101), ("b", 12), ("c", 3), ("d", 4)]),
        (3, [("b", 1000)], [("a", 101), ("b", 1012), ("c", 3), ("d", 4)]),
    ]:
        send(spark, store, batch, pairs)
        assert fact.complete(spark)
        assert read(spark, fact) == expected
    fact.fold(spark)
    assert read(spark, fact) == expected
    send(spark, store, 4, [("c", 7)])
    assert fact.complete(spark)
    assert read(spark, fact) == [("a", 101), ("b", 1012), ("c", 10), ("d", 4)]


def test_rows_that_were_all_replaced_are_not_shuffled(spark, stored):
    store, fact = stored
    orders = [(str(k), k) for k in range(500)]
    for batch in range(2):
        send(spark, store, batch, orders)
        assert fact.complete(spark)
    found = fact.read(spark)
    assert {r["n"] for r in found.collect()} == {2 * k for k in range(500)}
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


def test_orders_are_built_in_slices_and_shuffles_end_with_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(late, "SLICE_ORDERS", 20)
    held, seen = [], []

    def build(changes):
        held.append(changes.filter("table = 'order_detail'").count())
        seen.append(sum(len(files) for root, _, files in os.walk(tmp_path / "fact" / "late") if "_SUCCESS" in files))
        return facts.order_wide(changes, inputs.dictionary(spark))

    store = ChangeStore(str(tmp_path / "changes"))
    tables = ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon")
    fact = CompletedFact(str(tmp_path / "fact"), store, build, tables, by_order=("order_info", "order_detail"))
    rows = []
    for k in range(100):
        rows += [("order_info", {"id": str(k), "user_id": f"u{k}"})] * (1 + k % 2)
        rows += [("order_detail", {"id": str(d), "order_id": str(k), "source_type": "2401"}) for d in (10 * k, 10 * k + 1, 7)]
        # Links name another order than their detail, or none that is known.
        rows += [("order_detail_activity", {"id": f"a{k}", "order_detail_id": str(10 * k), "order_id": str(99 - k)})]
        rows += [("order_detail_coupon", {"id": f"c{k}", "order_detail_id": str(10 * k + 1), "order_id": "none"})]
    changes = spark.createDataFrame(
        [("shop", t, "insert", d, None, "0") for t, d in rows],
        "database string, table string, type string, data map<string,string>, old map<string,string>, ts string")
    text = lambda df: sorted(str(r) for r in df.select(*schemas.ORDER_WIDE_TEXT).collect())
    store.writer()(changes, 0)
    assert fact.complete(spark)
    assert len(held) == late.SLICES and sum(held) == 300 and max(held) < 300 and not any(seen)
    assert text(fact.read(spark)) == text(facts.order_wide(changes, inputs.dictionary(spark)))
    assert spark.conf.get(SHUFFLES_END) == "false"


def test_a_completion_that_broke_off_is_no_completion_and_is_written_again(spark, stored, tmp_path):
    store, fact = stored
    write_batch(spark.createDataFrame([("a", 5), ("z", 6)], "order_id string, n long"), f"{fact.root}/late", 0, finished=False)
    send(spark, store, 0, [("a", 1)])
    with pytest.raises(FileNotFoundError):
        fact.read(spark)
    assert fact.complete(spark)
    assert read(spark, fact) == [("a", 1)]
