"""Stream-stream joins of change rows, bounded in event time.

Both sides carry a watermark and the join condition bounds the distance of their event times, so Spark can
drop join state.  A left outer row without a partner is sent when the watermark rules a partner out; `changelog_left_join`
sends it at once and takes it back when a partner comes.  Partners further apart than the bound are found by
`retailflow.streaming.late`, which completes what these joins began.

The dictionary may be None: names then stay null, and `NAMES` says what `lookup.name_codes` fills in after the join, in the
batch writer (`jobs.dictionary_writer`), with the dictionary as it stands then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retailflow import schemas
from retailflow.operators.lookup import dictionary_join
from retailflow.plans import facts

# Fixed values.
WATERMARK = "2 seconds"
ORDER_BOUND = "5 seconds"
PAYMENT_BOUND = "905 seconds"

EVENT_TIME = "event_time"

# Code and name columns of the facts.
NAMES = {
    "order_wide": {"source_type_id": "source_type_name"},
    "pay_detail": {"source_type_id": "source_type_name", "payment_type_code": "payment_type_name"},
    "order_refund": {
        "refund_type_code": "refund_type_name", "refund_reason_type_code": "refund_reason_type_name"},
    "refund_paid": {"payment_type_code": "payment_type_name"},
}

# Columns of `changelog_left_join`: a greater version wins, and a deleted row is gone.
VERSION, DELETED = "_version", "_deleted"


def with_event_time(changes: DataFrame, seconds: str = "ts", delay: str = WATERMARK) -> DataFrame:
    """Event time of change rows from their epoch seconds, with a watermark."""
    return changes.withColumn(
        EVENT_TIME, F.timestamp_seconds(F.col(seconds).try_cast("bigint"))
    ).withWatermark(EVENT_TIME, delay)


def bounded_join(
    left: DataFrame, right: DataFrame, keys: list[str], bound: str, how: str = "inner"
) -> DataFrame:
    """Equi-join of two streams whose event times lie at most ``bound`` apart; the left one's is kept."""
    renamed = right.withColumnRenamed(EVENT_TIME, "_right_time")
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_right_{key}")
    condition = F.col("_right_time").between(
        F.col(EVENT_TIME) - F.expr(f"interval {bound}"), F.col(EVENT_TIME) + F.expr(f"interval {bound}")
    )
    for key in keys:
        condition &= F.col(key) == F.col(f"_right_{key}")
    joined = left.join(renamed, condition, how)
    # One event-time column per stage: later stateful operators refuse two.
    return joined.drop("_right_time", *[f"_right_{key}" for key in keys])


def changelog_left_join(
    left: DataFrame, right: DataFrame, keys: list[str], bound: str, partner: str
) -> DataFrame:
    """Left outer join as changes: every left row at once without a partner, taken back when a partner comes.

    ``partner`` is a column of ``right`` that is never null and tells partners of one left row apart.  Stored in a versioned
    `KeyedTable` with deletes, keyed by what identifies a left row and ``partner``, the changes read as the left outer
    join.  Output: columns of both sides, `VERSION` and `DELETED`.
    """
    added = [f for f in right.schema.fields if f.name not in {*keys, EVENT_TIME}]
    alone = [F.lit(None).cast(f.dataType).alias(f.name) for f in added]

    def change(names: list, version: int, gone: bool):
        return F.struct(*left.columns, *names, F.lit(version).alias(VERSION), F.lit(gone).alias(DELETED))

    pairs = bounded_join(left, right, keys, bound)
    found = pairs.select(F.explode(F.array(
        change([F.col(f.name) for f in added], 1, False), change(alone, 1, True))).alias("_change"))
    return left.select(change(alone, 0, False).alias("_change")).unionByName(found).select("_change.*")


def order_wide(
    changes: DataFrame, dictionary: DataFrame | None, database: str | None = None, bound: str = ORDER_BOUND
) -> DataFrame:
    """Streaming form of `facts.order_wide`; ``changes`` comes from `with_event_time`."""
    keep = [EVENT_TIME]
    detail = dictionary_join(
        facts.order_details(changes, database, keep), dictionary, "source_type", "source_type_name"
    ).withColumnRenamed("source_type", "source_type_id")
    wide = bounded_join(detail, facts.order_states(changes, database, keep), ["order_id"], bound)
    wide = bounded_join(wide, facts.order_activities(changes, database, keep), ["id"], bound, "left")
    wide = bounded_join(wide, facts.order_coupons(changes, database, keep), ["id"], bound, "left")
    return wide.select(*schemas.ORDER_WIDE_TEXT, "old", EVENT_TIME)


def pay_detail(
    changes: DataFrame, details: DataFrame, dictionary: DataFrame | None, database: str | None = None,
    bound: str = PAYMENT_BOUND,
) -> DataFrame:
    """Streaming form of `facts.pay_detail`; ``details`` carries an event time with a watermark."""
    paid = dictionary_join(
        facts.payments(changes, database, [EVENT_TIME]), dictionary, "payment_type_code",
        "payment_type_name",
    )
    joined = bounded_join(paid, details, ["order_id"], bound)
    return facts.shape_pay_detail(joined, [EVENT_TIME])


def order_refund(
    changes: DataFrame, dictionary: DataFrame | None, database: str | None = None, bound: str = ORDER_BOUND
) -> DataFrame:
    """Streaming form of `facts.order_refund`."""
    keep = [EVENT_TIME]
    requests = facts.refund_requests(changes, dictionary, database, keep)
    orders = facts.orders_moved_to(
        changes, schemas.ORDER_REFUND_REQUESTED, ["province_id"], database, keep
    )
    return facts.shape_order_refund(bounded_join(requests, orders, ["order_id"], bound), keep)


def refund_paid(
    changes: DataFrame, dictionary: DataFrame | None, database: str | None = None, bound: str = ORDER_BOUND
) -> DataFrame:
    """Streaming form of `facts.refund_paid`."""
    keep = [EVENT_TIME]
    paid = facts.refund_payments(changes, dictionary, database, keep)
    orders = facts.orders_moved_to(
        changes, schemas.ORDER_REFUND_PAID, ["user_id", "province_id"], database, keep
    )
    requests = facts.refunded_items(changes, database, keep)
    joined = bounded_join(paid, orders, ["order_id"], bound)
    joined = bounded_join(joined, requests, ["order_id", "sku_id"], bound)
    return facts.shape_refund_paid(joined, keep)
