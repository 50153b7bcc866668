from __future__ import annotations

import pytest

from retailflow import schemas
from retailflow.operators.changelog import live_changes
from retailflow.plans import dims, facts


@pytest.fixture(scope="module")
def dic(spark):
    return spark.createDataFrame(
        [("2401", "search"), ("1101", "card"), ("1501", "money only"), ("1301", "broken"), ("1201", "good")],
        "dic_code STRING, dic_name STRING",
    )


def changes(spark, *rows):
    """rows: (table, type, data, old)"""
    return spark.createDataFrame(
        [("shop", t, k, d, o, "1") for t, k, d, o in rows], schemas.CHANGELOG
    )


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def cart(spark, dic, *rows):
    base = {"user_id": "u", "source_type": "2401"}
    frame = changes(spark, *[
        ("cart_info", kind, {**base, "id": i, **({"sku_num": now} if now else {})}, old)
        for i, kind, now, old in rows
    ])
    return {r["id"]: r["sku_num"] for r in facts.cart_add(frame, dic, "shop").collect()}


def test_cart_add(spark, dic):
    got = cart(
        spark, dic,
        ("insert", "insert", "3", None),
        ("raised", "update", "5", {"sku_num": "2"}),
        ("equal", "update", "5", {"sku_num": "5"}),
        ("lowered", "update", "1", {"sku_num": "2"}),
        ("other", "update", "5", {"is_checked": "1"}),
        ("text", "update", "5x", {"sku_num": "2"}),
        ("gone", "delete", "5", None),
    )
    assert got == {"insert": "3", "raised": "3"}


def test_cart_add_needs_the_database(spark, dic):
    frame = changes(spark, ("cart_info", "insert", {"id": "1", "source_type": "2401"}, None))
    assert facts.cart_add(frame, dic, "other").count() == 0
    assert facts.cart_add(frame, dic).count() == 1


def order_changes(spark):
    detail = {"order_id": "o", "sku_id": "s", "source_type": "2401", "split_total_amount": "1.50"}
    return changes(
        spark,
        ("order_detail", "insert", {"id": "d1", **detail}, None),
        ("order_detail", "insert", {"id": "d2", **detail}, None),
        ("order_detail", "insert", {"id": "d3", **detail, "source_type": "9999"}, None),
        ("order_detail", "update", {"id": "d4", **detail}, {"sku_num": "1"}),
        ("order_info", "insert", {"id": "o", "order_status": "1001", "user_id": "u"}, None),
        ("order_info", "update", {"id": "o", "order_status": "1003", "operate_time": "t"},
         {"order_status": "1001"}),
        ("order_info", "update", {"id": "o", "order_status": "1003", "operate_time": "t2"},
         {"order_comment": "x"}),
        ("order_detail_activity", "insert", {"id": "a1", "order_detail_id": "d1", "activity_id": "7"}, None),
        ("order_detail_coupon", "insert", {"id": "c2", "order_detail_id": "d2", "coupon_id": "8"}, None),
        ("payment_info", "update",
         {"order_id": "o", "payment_type": "1101", "payment_status": "1602", "callback_time": "cb"}, None),
        ("payment_info", "update", {"order_id": "o", "payment_type": "1101", "payment_status": "1601"}, None),
        ("payment_info", "insert", {"order_id": "o", "payment_type": "1101", "payment_status": "1602"}, None),
    )


def test_order_facts(spark, dic):
    frame = order_changes(spark)
    wide = facts.order_wide(frame, dic, "shop")
    assert wide.columns == [*schemas.ORDER_WIDE_TEXT, "old"]
    assert ids(wide) == ["d1"] * 3 + ["d2"] * 3
    got = {(r["id"], r["activity_id"], r["coupon_id"]) for r in wide.collect()}
    assert got == {("d1", "7", None), ("d2", None, "8")}
    detail = facts.order_detail(wide)
    assert detail.columns == schemas.ORDER_DETAIL and ids(detail) == ["d1", "d2"]
    cancelled = facts.order_cancel(wide).collect()
    assert [(r["id"], r["cancel_time"]) for r in sorted(cancelled)] == [("d1", "t"), ("d2", "t")]
    paid = facts.pay_detail(frame, detail, dic)
    assert ids(paid, "order_detail_id") == ["d1", "d2"]
    assert {(r["payment_type_name"], r["callback_time"], r["split_payment_amount"]) for r in paid.collect()} == {
        ("card", "cb", "1.50")}
    assert "row_op_ts" in facts.with_operation_time(detail).columns


def test_refund_facts(spark, dic):
    request = {"order_id": "o", "sku_id": "s", "refund_type": "1501", "refund_reason_type": "1301",
               "create_time": "2022-04-01 10:00:00", "refund_num": "1"}
    frame = changes(
        spark,
        ("order_refund_info", "insert", {"id": "r1", **request}, None),
        ("order_refund_info", "insert", {"id": "r2", **request, "refund_type": "9999"}, None),
        ("order_refund_info", "update", {"id": "r3", **request, "sku_id": "s2"}, None),
        ("order_info", "update", {"id": "o", "order_status": "1005", "province_id": "1"}, {"order_status": "1002"}),
        ("order_info", "update", {"id": "o", "order_status": "1005"}, {"order_comment": "1002"}),
        ("order_info", "update", {"id": "o", "order_status": "1006", "user_id": "u"}, {"order_status": "1005"}),
        ("refund_payment", "update", {"id": "p1", "order_id": "o", "sku_id": "s", "payment_type": "1101",
                                      "callback_time": "2022-04-02 10:00:00"}, None),
        ("refund_payment", "insert", {"id": "p2", "order_id": "o", "sku_id": "s2", "payment_type": "1101"}, None),
        ("refund_payment", "insert", {"id": "p3", "order_id": "o", "sku_id": "s3", "payment_type": "1101"}, None),
    )
    refunds = facts.order_refund(frame, dic).collect()
    assert [(r["id"], r["refund_type_name"], r["refund_reason_type_name"], r["date_id"], r["province_id"])
            for r in refunds] == [("r1", "money only", "broken", "2022-04-01", "1")]
    paid = facts.refund_paid(frame, dic)
    # requests r1 and r2 share order and sku, so p1 comes twice; any operation type counts
    assert ids(paid) == ["p1", "p1", "p2"]


def test_coupon_favour_comment_user(spark, dic):
    frame = changes(
        spark,
        ("coupon_use", "insert", {"id": "1", "get_time": "2022-04-01 10:00:00"}, None),
        ("coupon_use", "update", {"id": "2", "coupon_status": "1402", "using_time": "2022-04-02 10:00:00"},
         {"coupon_status": "1401"}),
        ("coupon_use", "update", {"id": "3", "coupon_status": "1402"}, {"get_time": "x"}),
        ("coupon_use", "update", {"id": "4", "coupon_status": "1403", "used_time": "2022-04-03 10:00:00"}, None),
        ("favor_info", "insert", {"id": "5", "is_cancel": "1"}, None),
        ("favor_info", "update", {"id": "6", "is_cancel": "0"}, None),
        ("favor_info", "update", {"id": "7", "is_cancel": "1"}, None),
        ("comment_info", "insert", {"id": "8", "appraise": "1201"}, None),
        ("comment_info", "insert", {"id": "9", "appraise": "1299"}, None),
        ("user_info", "insert", {"id": "10", "create_time": "2022-04-01 10:00:00"}, None),
        ("user_info", "bootstrap-insert", {"id": "11"}, None),
    )
    assert ids(facts.coupon_get(frame)) == ["1"]
    assert [(r["id"], r["date_id"]) for r in facts.coupon_order(frame).collect()] == [("2", "2022-04-02")]
    assert [(r["id"], r["date_id"]) for r in facts.coupon_pay(frame).collect()] == [("4", "2022-04-03")]
    assert ids(facts.favor_add(frame)) == ["5", "6"]
    assert [(r["id"], r["appraise_name"]) for r in facts.comment(frame, dic).collect()] == [("8", "good")]
    assert ids(facts.user_register(frame), "user_id") == ["10"]
    assert live_changes(frame).count() == frame.count()


def test_dimension_routing(spark):
    frame = changes(
        spark,
        ("sku", "insert", {"id": "1", "name": "a", "secret": "x"}, None),
        ("sku", "update", {"id": "1", "name": "b", "secret": "x"}, None),
        ("sku", "delete", {"id": "1", "name": "c"}, None),
        ("shop", "bootstrap-insert", {"code": "7", "name": "s"}, None),
        ("other", "insert", {"id": "1"}, None),
    ).withColumn("ts", __import__("pyspark").sql.functions.expr("if(type = 'update', '2', '1')"))
    config = spark.createDataFrame(
        [("sku", "dim_sku", "id,name", None, None), ("shop", "dim_shop", "code, name", "code", None)],
        schemas.DIM_CONFIG,
    )
    routed = dims.route_dimensions(frame, config)
    got = sorted((r["sink_table"], r["sink_pk"], r["pk"], r["type"], tuple(sorted(r["data"].items())))
                 for r in routed.collect())
    assert got == [
        # " name" with its blank is another name
        ("dim_shop", "code", "7", "bootstrap-insert", (("code", "7"),)),
        ("dim_sku", "id", "1", "insert", (("id", "1"), ("name", "a"))),
        ("dim_sku", "id", "1", "update", (("id", "1"), ("name", "b"))),
    ]
    table = dims.dimension_table(dims.latest_rows(routed), "dim_sku", "id,name")
    assert [tuple(r) for r in table.collect()] == [("1", "b")]
