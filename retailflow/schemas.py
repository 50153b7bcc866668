"""Schemas of the input topics and column orders of the outputs.

Everything in this file is a fixed value: names, order and types are the data format that writers and
readers of the topics and result tables agree on.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
TEXT_MAP = T.MapType(TEXT, TEXT)


def _columns(*names: str, **typed: T.DataType) -> T.StructType:
    """Text columns, then columns of the given types."""
    fields = [T.StructField(name, TEXT) for name in names]
    return T.StructType(fields + [T.StructField(name, kind) for name, kind in typed.items()])


LOG = _columns(
    common=_columns("mid", "uid", "vc", "ch", "ar", "is_new"),
    page=_columns("page_id", "last_page_id", "item", "item_type", during_time=T.LongType()),
    start=TEXT,
    displays=T.ArrayType(TEXT_MAP),
    actions=T.ArrayType(TEXT_MAP),
    err=TEXT,
    ts=T.LongType(),
)

CHANGELOG = _columns("database", "table", "type", data=TEXT_MAP, old=TEXT_MAP, ts=TEXT)

DICTIONARY = _columns(
    "dic_code", "dic_name", "parent_code", create_time=T.TimestampType(), operate_time=T.TimestampType()
)

DIM_CONFIG = _columns("sourceTable", "sinkTable", "sinkColumns", "sinkPk", "sinkExtend")

# Keys read from `data` per source table.
SOURCE_KEYS = {
    "cart_info": [
        "id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked", "create_time",
        "operate_time", "is_ordered", "order_time", "source_type", "source_id",
    ],
    "order_detail": [
        "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time", "source_type",
        "source_id", "split_total_amount", "split_activity_amount", "split_coupon_amount",
    ],
    "order_info": [
        "id", "consignee", "consignee_tel", "total_amount", "order_status", "user_id", "payment_way",
        "delivery_address", "order_comment", "out_trade_no", "trade_body", "create_time", "operate_time",
        "expire_time", "process_status", "tracking_no", "parent_order_id", "province_id",
        "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee",
        "feight_fee_reduce", "refundable_time",
    ],
    "order_detail_activity": [
        "id", "order_id", "order_detail_id", "activity_id", "activity_rule_id", "sku_id", "create_time",
    ],
    "order_detail_coupon": [
        "id", "order_id", "order_detail_id", "coupon_id", "coupon_use_id", "sku_id", "create_time",
    ],
    "payment_info": ["user_id", "order_id", "payment_type", "callback_time"],
    "order_refund_info": [
        "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
        "refund_reason_type", "refund_reason_txt", "create_time",
    ],
    "refund_payment": ["id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"],
    "comment_info": ["id", "user_id", "sku_id", "order_id", "create_time", "appraise"],
}

# Order status and coupon status codes.
ORDER_CANCELLED = "1003"
ORDER_REFUND_REQUESTED = "1005"
ORDER_REFUND_PAID = "1006"
PAYMENT_PAID = "1602"
COUPON_UNUSED = "1401"
COUPON_ORDERED = "1402"

# Columns of the wide order fact, in write order (without `old` and `row_op_ts`).
ORDER_WIDE_TEXT = [
    "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time", "source_type_id",
    "source_type_name", "source_id", "split_total_amount", "split_activity_amount", "split_coupon_amount",
    "consignee", "consignee_tel", "total_amount", "order_status", "user_id", "payment_way",
    "delivery_address", "order_comment", "out_trade_no", "trade_body", "operate_time", "expire_time",
    "process_status", "tracking_no", "parent_order_id", "province_id", "activity_reduce_amount",
    "coupon_reduce_amount", "original_total_amount", "feight_fee", "feight_fee_reduce", "refundable_time",
    "order_detail_activity_id", "activity_id", "activity_rule_id", "order_detail_coupon_id", "coupon_id",
    "coupon_use_id", "type",
]

ORDER_DETAIL = [
    "id", "order_id", "user_id", "sku_id", "sku_name", "sku_num", "order_price", "province_id",
    "activity_id", "activity_rule_id", "coupon_id", "create_time", "source_id", "source_type_id",
    "source_type_name", "split_activity_amount", "split_coupon_amount", "split_total_amount",
]

ORDER_CANCEL = [
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
    "coupon_id", "cancel_time", "source_id", "source_type_id", "source_type_name", "sku_num",
    "order_price", "split_activity_amount", "split_coupon_amount", "split_total_amount",
]

PAY_DETAIL = [
    "order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "payment_type_code", "payment_type_name", "callback_time",
    "source_id", "source_type_id", "source_type_name", "sku_num", "order_price",
    "split_activity_amount", "split_coupon_amount", "split_payment_amount",
]

# Public columns of the window results, in write order. `ts` is wall-clock and is added at the sink.
WINDOW_RESULTS = {
    "keyword": ["stt", "edt", "source", "keyword", "keyword_count"],
    "traffic": ["stt", "edt", "vc", "ch", "ar", "isNew", "uvCt", "svCt", "pvCt", "durSum", "ujCt"],
    "home_detail": ["stt", "edt", "homeUvCt", "goodDetailUvCt"],
    "user_login": ["stt", "edt", "backCt", "uuCt"],
    "user_register": ["stt", "edt", "registerCt"],
    "cart_add": ["stt", "edt", "cartAddUuCt"],
    "payment": ["stt", "edt", "paymentSucUniqueUserCount", "paymentSucNewUserCount"],
    "order": [
        "stt", "edt", "orderUniqueUserCount", "orderNewUserCount", "orderActivityReduceAmount",
        "orderCouponReduceAmount", "orderOriginalTotalAmount",
    ],
    "province_order": ["stt", "edt", "provinceId", "provinceName", "orderCount", "orderAmount"],
    "user_spu_order": [
        "stt", "edt", "trademarkId", "trademarkName", "category1Id", "category1Name", "category2Id",
        "category2Name", "category3Id", "category3Name", "userId", "spuId", "spuName", "orderCount",
        "orderAmount",
    ],
    "refund": [
        "stt", "edt", "trademarkId", "trademarkName", "category1Id", "category1Name", "category2Id",
        "category2Name", "category3Id", "category3Name", "userId", "refundCount",
    ],
}
