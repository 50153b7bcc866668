"""Fact tables built from the shop's change rows: carts, orders, payments, refunds, coupons, reviews.

Each function takes the change frame (and the dictionary where codes are named) and returns the fact
frame with the columns its consumers read.  Text stays text; amounts are cast where they are summed.
A row operation time is added at the sink with `with_operation_time`, never inside a fact.

The order join can be bounded in event time for streaming use: see `retailflow.streaming.joins`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retailflow import schemas
from retailflow.functions.times import date_id
from retailflow.operators.changelog import (
    INSERT, UPDATE, cart_additions, changed, fields, of_table, table_columns,
)
from retailflow.operators.lookup import dictionary_join


# Extra columns of the change rows to carry along, such as an event time.
Keep = Sequence[str]


OPERATION_TIME = "row_op_ts"


def with_operation_time(fact: DataFrame, name: str = OPERATION_TIME, at: Column | None = None) -> DataFrame:
    """Stamp a row's version: ``at``, or else the time of writing, which is constant within one batch."""
    return fact.withColumn(name, F.current_timestamp() if at is None else at)


def _stamp(fact: DataFrame) -> list[str]:
    """The version column, if the fact carries one: the facts made of it carry it on."""
    return [OPERATION_TIME] if OPERATION_TIME in fact.columns else []


def _data(key: str) -> Column:
    return F.col("data")[key]


def _day_of(key: str) -> Column:
    return date_id(_data(key)).alias("date_id")


def cart_add(changes: DataFrame, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    added = dictionary_join(
        cart_additions(changes, database), dictionary, "source_type", "source_type_name"
    )
    return added.select(
        "id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked", "create_time",
        "operate_time", "is_ordered", "order_time", F.col("source_type").alias("source_type_id"),
        "source_type_name", "source_id",
    )


# --- orders -----------------------------------------------------------------------------------------


def order_details(changes: DataFrame, database: str | None = None, keep: Keep = ()) -> DataFrame:
    return of_table(changes, "order_detail", [INSERT], database).select(
        *table_columns("order_detail"), *keep
    )


def order_states(changes: DataFrame, database: str | None = None, keep: Keep = ()) -> DataFrame:
    """Every version of an order: its insert and all later updates, with operation type and old values."""
    names = [c for c in schemas.SOURCE_KEYS["order_info"] if c not in ("id", "create_time")]
    return of_table(changes, "order_info", [INSERT, UPDATE], database).select(
        _data("id").alias("order_id"), *fields(names), "type", "old", *keep
    )


def order_activities(changes: DataFrame, database: str | None = None, keep: Keep = ()) -> DataFrame:
    return of_table(changes, "order_detail_activity", [INSERT], database).select(
        _data("order_detail_id").alias("id"), _data("id").alias("order_detail_activity_id"),
        *fields(["activity_id", "activity_rule_id"]), *keep,
    )


def order_coupons(changes: DataFrame, database: str | None = None, keep: Keep = ()) -> DataFrame:
    return of_table(changes, "order_detail_coupon", [INSERT], database).select(
        _data("order_detail_id").alias("id"), _data("id").alias("order_detail_coupon_id"),
        *fields(["coupon_id", "coupon_use_id"]), *keep,
    )


def order_wide(changes: DataFrame, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    """One row per order detail and version of its order, with its activity and coupon if any.

    The dictionary join comes first because it only drops rows; the two joins on the detail id come next
    and share its partitioning; the order join, which multiplies rows, comes last.
    """
    detail = dictionary_join(
        order_details(changes, database), dictionary, "source_type", "source_type_name"
    ).withColumnRenamed("source_type", "source_type_id")
    wide = (
        detail.join(order_activities(changes, database), "id", "left")
        .join(order_coupons(changes, database), "id", "left")
        .join(order_states(changes, database), "order_id", "inner")
    )
    return wide.select(*schemas.ORDER_WIDE_TEXT, "old")


def order_detail(wide: DataFrame) -> DataFrame:
    """Placed order details: the versions that came with the order's insert, with their ``row_op_ts`` if stamped."""
    return wide.filter(F.col("type") == INSERT).select(*schemas.ORDER_DETAIL, *_stamp(wide))


def order_cancel(wide: DataFrame) -> DataFrame:
    """Cancelled order details: the update that moved the order to the cancelled status."""
    return wide.filter(
        (F.col("type") == UPDATE) & changed("order_status")
        & (F.col("order_status") == schemas.ORDER_CANCELLED)
    ).withColumnRenamed("operate_time", "cancel_time").select(*schemas.ORDER_CANCEL)


# --- payments and refunds ---------------------------------------------------------------------------


def payments(changes: DataFrame, database: str | None = None, keep: Keep = ()) -> DataFrame:
    return of_table(changes, "payment_info", [UPDATE], database).filter(
        _data("payment_status") == schemas.PAYMENT_PAID
    ).select(
        _data("order_id").alias("order_id"), _data("payment_type").alias("payment_type_code"),
        _data("callback_time").alias("callback_time"), *keep,
    )


def shape_pay_detail(joined: DataFrame, keep: Keep = ()) -> DataFrame:
    return (
        joined.withColumnRenamed("id", "order_detail_id")
        .withColumnRenamed("split_total_amount", "split_payment_amount")
        .select(*schemas.PAY_DETAIL, *_stamp(joined), *keep)
    )


def pay_detail(
    changes: DataFrame, details: DataFrame, dictionary: DataFrame, database: str | None = None
) -> DataFrame:
    """Details of paid orders: a payment fans out to every detail of its order."""
    paid = dictionary_join(
        payments(changes, database), dictionary, "payment_type_code", "payment_type_name"
    )
    return shape_pay_detail(details.join(paid, "order_id", "inner"))


def orders_moved_to(
    changes: DataFrame, status: str, names: list[str], database: str | None = None, keep: Keep = ()
) -> DataFrame:
    """Orders whose update changed their status to the given one."""
    return of_table(changes, "order_info", [UPDATE], database).filter(
        (_data("order_status") == status) & changed("order_status")
    ).select(_data("id").alias("order_id"), *fields(names), *keep)


def refund_requests(
    changes: DataFrame, dictionary: DataFrame | None, database: str | None = None, keep: Keep = ()
) -> DataFrame:
    """Refund requests with type and reason named: the dictionary is joined once for each code."""
    requests = of_table(changes, "order_refund_info", [INSERT], database).select(
        *table_columns("order_refund_info"), "ts", *keep
    )
    named = dictionary_join(requests, dictionary, "refund_type", "refund_type_name")
    return dictionary_join(named, dictionary, "refund_reason_type", "refund_reason_type_name")


def shape_order_refund(joined: DataFrame, keep: Keep = ()) -> DataFrame:
    return joined.select(
        "id", "user_id", "order_id", "sku_id", "province_id", date_id(F.col("create_time")).alias("date_id"),
        "create_time", F.col("refund_type").alias("refund_type_code"), "refund_type_name",
        F.col("refund_reason_type").alias("refund_reason_type_code"), "refund_reason_type_name",
        "refund_reason_txt", "refund_num", "refund_amount", "ts", *keep,
    )


def order_refund(changes: DataFrame, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    """Refund requests of orders that moved to the refund status, with type and reason named."""
    orders = orders_moved_to(changes, schemas.ORDER_REFUND_REQUESTED, ["province_id"], database)
    requests = refund_requests(changes, dictionary, database)
    return shape_order_refund(requests.join(orders, "order_id", "inner"))


def refund_payments(
    changes: DataFrame, dictionary: DataFrame | None, database: str | None = None, keep: Keep = ()
) -> DataFrame:
    rows = of_table(changes, "refund_payment", database=database).select(
        *table_columns("refund_payment"), "ts", *keep
    )
    return dictionary_join(rows, dictionary, "payment_type", "payment_type_name")


def refunded_items(changes: DataFrame, database: str | None = None, keep: Keep = ()) -> DataFrame:
    return of_table(changes, "order_refund_info", database=database).select(
        *fields(["order_id", "sku_id", "refund_num"]), *keep
    )


def shape_refund_paid(joined: DataFrame, keep: Keep = ()) -> DataFrame:
    return joined.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        F.col("payment_type").alias("payment_type_code"), "payment_type_name",
        date_id(F.col("callback_time")).alias("date_id"), "callback_time", "refund_num",
        F.col("total_amount").alias("refund_amount"), "ts", *keep,
    )


def refund_paid(changes: DataFrame, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    """Refund payments joined to their order and, on order and sku, to the refund request.

    Refund payments and refund requests are taken with any operation type and status.
    """
    paid = refund_payments(changes, dictionary, database)
    orders = orders_moved_to(changes, schemas.ORDER_REFUND_PAID, ["user_id", "province_id"], database)
    requests = refunded_items(changes, database)
    return shape_refund_paid(
        paid.join(orders, "order_id", "inner").join(requests, ["order_id", "sku_id"], "inner")
    )


# --- coupons, favourites, comments, registrations ----------------------------------------------------


def coupon_get(changes: DataFrame, database: str | None = None) -> DataFrame:
    return of_table(changes, "coupon_use", [INSERT], database).select(
        *fields(["id", "coupon_id", "user_id"]), _day_of("get_time"), *fields(["get_time"]), "ts"
    )


def coupon_order(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Coupons put on an order: the status moved from unused to ordered."""
    moved = (_data("coupon_status") == schemas.COUPON_ORDERED) & (
        F.col("old")["coupon_status"] == schemas.COUPON_UNUSED
    )
    return of_table(changes, "coupon_use", [UPDATE], database).filter(moved).select(
        *fields(["id", "coupon_id", "user_id", "order_id"]), _day_of("using_time"),
        _data("using_time").alias("order_time"), "ts",
    )


def coupon_pay(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Coupons of paid orders: an update that carries a time of use."""
    return of_table(changes, "coupon_use", [UPDATE], database).filter(
        _data("used_time").isNotNull()
    ).select(
        *fields(["id", "coupon_id", "user_id", "order_id"]), _day_of("used_time"),
        _data("used_time").alias("payment_time"), "ts",
    )


def favor_add(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Favourites added: new rows, and cancelled rows that were taken up again."""
    added = (F.col("type") == INSERT) | ((F.col("type") == UPDATE) & (_data("is_cancel") == "0"))
    return of_table(changes, "favor_info", database=database).filter(added).select(
        *fields(["id", "user_id", "sku_id"]), _day_of("create_time"), *fields(["create_time"]), "ts"
    )


def comment(changes: DataFrame, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    rows = of_table(changes, "comment_info", [INSERT], database).select(
        *table_columns("comment_info"), "ts"
    )
    return dictionary_join(rows, dictionary, "appraise", "appraise_name").select(
        "id", "user_id", "sku_id", "order_id", date_id(F.col("create_time")).alias("date_id"),
        "create_time", F.col("appraise").alias("appraise_code"), "appraise_name", "ts",
    )


def user_register(changes: DataFrame, database: str | None = None) -> DataFrame:
    return of_table(changes, "user_info", [INSERT], database).select(
        _data("id").alias("user_id"), _day_of("create_time"), *fields(["create_time"]), "ts"
    )
