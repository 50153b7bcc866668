"""Registered queries: each one runs an operator or a whole job over the given tables.

Every entry takes ``(spark, folder)`` and returns a DataFrame without maps, structs or wall-clock columns,
so that results can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, functions as F

from retailflow import schemas
from retailflow.functions import columns, times
from retailflow.functions.columns import map_text
from retailflow.functions.keywords import explode_words
from retailflow.operators import changelog, logs, lookup, visits, windows
from retailflow.plans import dims, facts
from retailflow.plans import windows as plan_windows
from retailflow.session import ROCKSDB_PROVIDER, scratch_path
from retailflow.sinks.bucketed import BucketedDimension
from retailflow.sinks.once import AppendOnce, settled
from retailflow.sinks.shape import json_lines, positional
from retailflow.sinks.tables import keyed_table
from retailflow.sources.records import changelog_rows, json_table
from retailflow.streaming import jobs, joins
from retailflow.streaming.late import ChangeStore, CompletedFact
from retailflow.tables import inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Widths that put several rows of the given tables into one window; the library default is ten seconds.
HOUR = "1 hour"
DAY = "1 day"
MONTH = "30 days"
JUMP_SECONDS = 4 * 3600


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- sources and sinks ------------------------------------------------------------------------------


@query
def src_json_table(spark, folder):
    lines = json_lines(inputs.table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total"),
    ))
    return json_table(lines, "order_id STRING, status STRING, total STRING")


@query
def src_changelog(spark, folder):
    lines = json_lines(inputs.order_changes(spark, folder))
    return changelog_rows(lines).select(
        "database", "table", "type", F.col("data")["id"].alias("id"),
        F.col("data")["order_status"].alias("order_status"),
        F.col("data")["total_amount"].alias("total_amount"),
        F.col("old")["order_status"].alias("old_status"), "ts",
    )


@query
def snk_json_roundtrip(spark, folder):
    customers = inputs.table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    return json_table(json_lines(customers), customers.schema)


@query
def snk_upsert_latest(spark, folder):
    """Keyed table of orders fed by two batches, the first one compacted: the last change of each order id wins."""
    changes = inputs.order_changes(spark, folder).select(
        *changelog.fields(["id", "order_status", "user_id", "operate_time"]), "ts",
        (F.col("type") == "update").alias("later"),
    )
    stored = keyed_table(scratch_path(spark, "orders"), "id", ["ts", "later"])
    stored.merge(changes.filter("not later"), 0)
    stored.compact(spark)
    stored.merge(changes.filter("later"), 1)
    return stored.read(spark).drop("later")


@query
def snk_upsert_delete(spark, folder):
    """Versioned keyed table of orders whose changes come in the wrong order: updates, inserts, then deletions of those
    with a refund; folded twice, with and without the marks of deletion."""
    changes = inputs.order_changes(spark, folder).select(
        *changelog.fields(["id", "order_status", "user_id", "operate_time"]), "ts",
        F.when(F.col("type") == "update", 2).otherwise(1).alias("version"), F.lit(False).alias("gone"),
    )
    stored = keyed_table(scratch_path(spark, "orders"), "id", "version", versioned=True, deleted="gone")
    refunds = changes.filter("version = 2 and order_status = '1005'")
    stored.merge(refunds.withColumns({"version": F.lit(3), "gone": F.lit(True)}), 0)
    stored.merge(changes.filter("version = 2"), 1)
    stored.compact(spark, keep_deletes=True)
    stored.merge(changes.filter("version = 1"), 2)
    stored.compact(spark)
    return stored.read(spark).drop("version")


@query
def snk_append_once(spark, folder):
    """Orders by status into a table that only takes appends: every batch is sent twice, and the first try of each breaks off
    after some of its rows."""
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    rows, ledger = scratch_path(spark, "appended"), scratch_path(spark, "ledger")
    broken = set()

    def append(df):
        number = df.select("_batch").first()
        if number is not None and number not in broken:
            broken.add(number)
            df.filter("o_orderpriority < '3'").write.mode("append").parquet(rows)
            raise ConnectionError("broken off")
        df.write.mode("append").parquet(rows)

    sink = AppendOnce("orders", scratch_path(spark, "stage"), append, lambda df: df.write.mode("append").parquet(ledger))
    open_orders = F.col("o_orderstatus").eqNullSafe("O")
    for number, part in enumerate([orders.filter(open_orders), orders.filter(~open_orders)]):
        for _ in range(3):
            try:
                sink(part, number)
            except ConnectionError:
                continue
    return settled(spark.read.parquet(rows), spark.read.parquet(ledger))


@query
def retract_left_join(spark, folder):
    """Order details and their activities as changes of a left outer join, stored and read back."""
    changes = joins.with_event_time(
        inputs.detail_changes(spark, folder).unionByName(inputs.activity_changes(spark, folder)).withColumn("ts", F.lit("0")))
    details = facts.order_details(changes, inputs.DATABASE, [joins.EVENT_TIME]).select("id", "order_id", joins.EVENT_TIME)
    rows = joins.changelog_left_join(
        details, facts.order_activities(changes, inputs.DATABASE, [joins.EVENT_TIME]), ["id"], joins.ORDER_BOUND,
        "order_detail_activity_id")
    # Both batches come out of one join, which is made once.
    landed = scratch_path(spark, "left-join-rows")
    rows.write.partitionBy(joins.VERSION).parquet(landed)
    rows = spark.read.schema(rows.schema).parquet(landed)
    stored = keyed_table(
        scratch_path(spark, "left-join"), ["id", "order_detail_activity_id"], joins.VERSION, versioned=True, deleted=joins.DELETED)
    # The order of the batches does not matter: what was taken back stays so.
    stored.merge(rows.filter(F.col(joins.VERSION) == 1), 0)
    stored.merge(rows.filter(F.col(joins.VERSION) == 0), 1)
    return stored.read(spark).select("id", "order_id", "order_detail_activity_id", "activity_id")


@query
def snk_positional_projection(spark, folder):
    """Positional columns of a window result, hidden accumulator and clock left out."""
    result = windows.province_order_window(
        _details(spark, folder), inputs.provinces(spark, folder), width=DAY
    ).withColumn("orderIdSet", F.array("orderCount"))
    return positional(result, hidden=["orderIdSet"]).toDF(*[f"p{i}" for i in range(1, 7)])


# --- logs -------------------------------------------------------------------------------------------


def _parsed(spark, folder):
    return logs.parse_logs(inputs.log_lines(spark, folder))


def _repaired(spark, folder):
    day = times.millis_wall(F.col("ts"), "+00:00").cast("date")
    # Dirty texts have a query of their own, so the text is not stored with the records.
    landed = logs.land_logs(logs.clean_logs(_parsed(spark, folder)), scratch_path(spark, "logs"))
    return logs.repair_logs(landed, day)


@query
def log_dirty_split(spark, folder):
    return logs.bad_lines(inputs.log_lines(spark, folder))


@query
def log_error(spark, folder):
    return logs.error_log(_repaired(spark, folder)).select(
        "common.mid", "common.is_new", "page.page_id", "err", "ts", map_text(F.col("common.more")).alias("common_more")
    )


@query
def log_start(spark, folder):
    return logs.start_log(_repaired(spark, folder)).select(
        "common.mid", "common.vc", "common.ch", "common.is_new", "start", "ts", map_text(F.col("common.more")).alias("common_more")
    )


@query
def log_display_explode(spark, folder):
    return logs.display_log(_repaired(spark, folder)).select(
        "common.mid", "common.is_new", "page_id", F.col("display")["item"].alias("item"),
        F.col("display")["pos_id"].alias("pos_id"), "ts",
        map_text(F.col("common.more")).alias("common_more"),
    )


@query
def log_action_explode(spark, folder):
    return logs.action_log(_repaired(spark, folder)).select(
        "common.mid", "common.is_new", "page_id", F.col("action")["action_id"].alias("action_id"),
        F.col("action")["item"].alias("item"), F.col("action")["ts"].alias("action_ts"),
        map_text(F.col("common.more")).alias("common_more"),
    )


@query
def log_page(spark, folder):
    pages = logs.page_log(_repaired(spark, folder))
    kept = [map_text(F.col(m)).alias(m.replace(".", "_")) for m in ("common.more", "page.more", "more")]
    return logs.page_columns(pages, kept)


@query
def is_new_repair(spark, folder):
    pages = inputs.page_rows(spark, folder)
    return logs.repair_new_visitor(
        pages, F.col("mid"), F.col("is_new"), F.col("ts").cast("date"), ["ts", "event_id"]
    ).select("event_id", "mid", "is_new", "repaired_is_new")


# --- visits -----------------------------------------------------------------------------------------


@query
def unique_visitor(spark, folder):
    return visits.unique_visitors(inputs.page_rows(spark, folder), ties=["event_id"]).select(
        "event_id", "mid", "vc", "ch", "ar", "is_new", "page_id", "ts"
    )


@query
def user_jump(spark, folder):
    return visits.user_jumps(
        inputs.page_rows(spark, folder), ties=["event_id"], span_seconds=JUMP_SECONDS
    ).select("event_id", "mid", "vc", "ch", "ar", "is_new", "page_id", "ts")


@query
def home_detail_uv_window(spark, folder):
    return windows.home_detail_window(
        visits.home_detail_visitors(inputs.page_rows(spark, folder)), width=HOUR
    )


@query
def user_login_window(spark, folder):
    return windows.login_window(visits.login_visitors(inputs.page_rows(spark, folder)), width=HOUR)


def _traffic(spark, folder):
    pages = inputs.page_rows(spark, folder)
    return windows.traffic_rows(
        pages,
        visits.unique_visitors(pages, ties=["event_id"]),
        visits.user_jumps(pages, ties=["event_id"], span_seconds=JUMP_SECONDS),
    )


@query
def traffic_union(spark, folder):
    return _traffic(spark, folder)


@query
def traffic_rollup_window(spark, folder):
    return windows.traffic_rollup(_traffic(spark, folder), width=DAY)


# --- keywords ---------------------------------------------------------------------------------------


@query
def keyword_explode(spark, folder):
    return explode_words(inputs.table(spark, folder, "documents").select("doc_id", "text"), "text")


@query
def keyword_han(spark, folder):
    """Conversations written in Han characters, cut by a word table."""
    return explode_words(inputs.han_texts(spark, folder), "text", inputs.han_vocabulary(spark, folder))


@query
def keyword_window(spark, folder):
    """Documents as search keywords, one a second, counted by word and ten seconds."""
    pages = inputs.table(spark, folder, "documents").select(
        F.struct(
            F.lit("search").alias("last_page_id"), F.lit("keyword").alias("item_type"),
            F.col("text").alias("item"),
        ).alias("page"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id)").alias("ts"),
    )
    searches = plan_windows.search_keywords(pages)
    return windows.keyword_counts(explode_words(searches, "item"))


# --- change rows ------------------------------------------------------------------------------------


@query
def cdc_project(spark, folder):
    changes = inputs.order_changes(spark, folder)
    return changelog.of_table(changes, "order_info", database=inputs.DATABASE).select(
        "type", *changelog.fields(
            ["id", "user_id", "province_id", "total_amount", "create_time"], {"id": "order_id"}
        )
    )


@query
def cdc_type_filter(spark, folder):
    changes = inputs.event_changes(spark, folder, "user_info")
    return changelog.live_changes(changes).select("type", *changelog.fields(["id", "create_time"]))


@query
def date_id(spark, folder):
    changes = inputs.order_changes(spark, folder).filter("type = 'update'")
    text = F.col("data")["operate_time"]
    return changes.select(
        F.col("data")["id"].alias("id"), times.date_id(text).alias("date_id"),
        times.text_day(text).alias("day_text"),
    )


@query
def cart_add(spark, folder):
    return facts.cart_add(
        inputs.cart_changes(spark, folder), inputs.dictionary(spark), inputs.DATABASE
    )


@query
def coupon_get(spark, folder):
    return facts.coupon_get(inputs.event_changes(spark, folder, "coupon_use"))


@query
def coupon_order(spark, folder):
    return facts.coupon_order(inputs.event_changes(spark, folder, "coupon_use"))


@query
def coupon_pay(spark, folder):
    return facts.coupon_pay(inputs.event_changes(spark, folder, "coupon_use"))


@query
def favor_add(spark, folder):
    return facts.favor_add(inputs.event_changes(spark, folder, "favor_info"))


@query
def comment(spark, folder):
    return facts.comment(inputs.event_changes(spark, folder, "comment_info"), inputs.dictionary(spark))


@query
def user_register(spark, folder):
    return facts.user_register(inputs.event_changes(spark, folder, "user_info"))


def _wide(spark, folder):
    return facts.order_wide(
        inputs.order_fact_changes(spark, folder), inputs.dictionary(spark), inputs.DATABASE
    )


@query
def order_wide(spark, folder):
    return _wide(spark, folder).select(
        *schemas.ORDER_WIDE_TEXT, F.col("old")["order_status"].alias("old_order_status")
    )


@query
def order_wide_completed(spark, folder):
    """The wide order rows out of stored changes in two batches, completed after each: the updates of the orders come
    with the second one, long after their details."""
    changes = inputs.order_fact_changes(spark, folder)
    dictionary = inputs.dictionary(spark)
    store = ChangeStore(scratch_path(spark, "changes"))
    fact = CompletedFact(
        scratch_path(spark, "wide"), store, lambda rows: facts.order_wide(rows, dictionary, inputs.DATABASE),
        ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon"),
        by_order=("order_info", "order_detail"))
    first = (F.col("table") == "order_detail") | ((F.col("table") == "order_info") & (F.col("type") == "insert"))
    store.writer()(changes.filter(first), 0)
    fact.complete(spark)
    store.writer()(changes.filter(~first), 1)
    fact.complete(spark)
    return fact.read(spark).select(*schemas.ORDER_WIDE_TEXT)


@query
def order_detail(spark, folder):
    return facts.order_detail(facts.with_operation_time(_wide(spark, folder), at=F.col("create_time")))


@query
def order_cancel(spark, folder):
    return facts.order_cancel(_wide(spark, folder))


@query
def pay_detail_suc(spark, folder):
    return facts.pay_detail(
        inputs.order_fact_changes(spark, folder), order_detail(spark, folder),
        inputs.dictionary(spark), inputs.DATABASE,
    )


@query
def order_refund(spark, folder):
    return facts.order_refund(inputs.refund_fact_changes(spark, folder), inputs.dictionary(spark))


@query
def refund_pay_suc(spark, folder):
    return facts.refund_paid(inputs.refund_fact_changes(spark, folder), inputs.dictionary(spark))


@query
def dic_lookup(spark, folder):
    rows = inputs.table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "cast(2400 + l_linenumber as string) as source_type"
    )
    return lookup.dictionary_join(rows, inputs.dictionary(spark), "source_type", "source_type_name")


# --- deduplication and trade windows ----------------------------------------------------------------

_ITEM_COLUMNS = [
    "id", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag",
]


@query
def dedup_first(spark, folder):
    return inputs.first_items(spark, folder).select(*_ITEM_COLUMNS)


@query
def dedup_latest(spark, folder):
    return inputs.latest_items(spark, folder).select(*_ITEM_COLUMNS)


def _details(spark, folder):
    return inputs.detail_rows(spark, folder, inputs.latest_items(spark, folder))


def _first_details(spark, folder):
    return inputs.detail_rows(spark, folder, inputs.first_items(spark, folder))


@query
def order_window(spark, folder):
    return windows.order_window(_first_details(spark, folder), width=DAY)


@query
def payment_window(spark, folder):
    paid = _details(spark, folder).filter("total_price > 100000")
    return windows.payment_window(visits.paying_users(paid, "user_id", "ts"), width=DAY)


@query
def cart_add_uu_window(spark, folder):
    carts = facts.cart_add(
        inputs.cart_changes(spark, folder), inputs.dictionary(spark), inputs.DATABASE
    )
    timed = plan_windows.cart_event_time(carts)
    return windows.cart_window(visits.daily_users(timed, "user_id", "ts"), width=DAY)


@query
def user_register_window(spark, folder):
    registered = facts.user_register(inputs.event_changes(spark, folder, "user_info"))
    timed = registered.withColumn("event_time", times.text_wall(F.col("create_time")))
    return windows.register_window(timed, ts="event_time", width=HOUR)


@query
def province_order_window(spark, folder):
    return windows.province_order_window(
        _details(spark, folder), inputs.provinces(spark, folder), width=DAY
    )


@query
def user_spu_order_window(spark, folder):
    return plan_windows.user_spu_order_window(
        _first_details(spark, folder), inputs.product_dimensions(spark, folder), width=MONTH
    )


@query
def refund_window(spark, folder):
    refunds = _details(spark, folder).filter("return_flag = 'R'")
    return plan_windows.refund_window(
        refunds, inputs.product_dimensions(spark, folder), width=MONTH
    )


@query
def traffic_stream(spark, folder):
    """The traffic rollup as one streaming query over stored pages, keyed state and windows chained.

    A last row a year on moves the watermark past all windows.
    """
    pages = inputs.page_rows(spark, folder).select(
        "mid", "vc", "ch", "ar", "is_new", "last_page_id", "during_time", F.col("ts").cast("timestamp").alias("ts"))
    end = pages.agg(F.max("ts").alias("ts")).select(
        *[F.lit("end").alias(c) for c in ("mid", "vc", "ch", "ar", "is_new", "last_page_id")],
        F.lit(0).cast("bigint").alias("during_time"), F.expr("ts + interval 365 days").alias("ts"))
    source, target = scratch_path(spark, "pages"), scratch_path(spark, "traffic")
    pages.unionByName(end).write.parquet(source)
    rollup = jobs.traffic(spark.readStream.schema(pages.schema).parquet(source), JUMP_SECONDS, HOUR)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ROCKSDB_PROVIDER)
    try:
        running = jobs.store(rollup, PurePosixPath(target).name, target, checkpoints=scratch_path(spark, "checkpoints"))
    finally:
        spark.conf.set(provider, before)
    running.awaitTermination()
    return spark.read.schema(rollup.schema).parquet(target).filter("not vc <=> 'end'")


# --- dimensions -------------------------------------------------------------------------------------


@query
def dim_lookup_left(spark, folder):
    """Customers looked up among suppliers by number: most have no match and keep nulls."""
    customers = inputs.table(spark, folder, "customer").select("c_custkey", "c_name")
    suppliers = inputs.table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return lookup.dimension_join(
        customers, suppliers, "c_custkey", {"s_name": "supplier", "s_nationkey": "supplier_nation"},
        dim_key="s_suppkey",
    )


@query
def dim_lookup_bucketed(spark, folder):
    """Sales by part, named from a bucketed snapshot of the parts and what changed since: large parts have a new name,
    small ones were deleted."""
    parts = inputs.table(spark, folder, "part").select(
        "p_partkey", "p_name", "p_brand", F.lit(False).alias("gone"), "p_size")
    stored = keyed_table(scratch_path(spark, "parts"), "p_partkey", [], deleted="gone")
    dimension = BucketedDimension(stored, PurePosixPath(stored.root).name.replace("-", "_"), 8, scratch_path(spark, "buckets"))
    stored.merge(parts, 0)
    dimension.refresh(spark)
    stored.merge(parts.filter("p_size > 40").withColumn("p_name", F.concat("p_name", F.lit(" new"))), 1)
    stored.merge(parts.filter("p_size < 5").withColumn("gone", F.lit(True)), 2)
    sold = inputs.table(spark, folder, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("sold"))
    return dimension.join(sold, "l_partkey", {"p_name": "part_name", "p_brand": "brand"})


@query
def snowflake_enrich(spark, folder):
    products = inputs.product_dimensions(spark, folder)
    sold = lookup.sku_attributes(
        inputs.line_items(spark, folder).select(F.col("l_partkey").alias("sku_id")), products.sku
    )
    totals = sold.groupBy("trademarkId", "category3Id").agg(F.count(F.lit(1)).alias("sold"))
    return products.chain(totals)


@query
def dim_route(spark, folder):
    routed = dims.route_dimensions(
        inputs.dimension_changes(spark, folder), inputs.dimension_config(spark)
    )
    return routed.select("sink_table", "sink_pk", "pk", "type", map_text(F.col("data")).alias("data"), "ts")


@query
def dim_filter_columns(spark, folder):
    routed = dims.route_dimensions(
        inputs.dimension_changes(spark, folder), inputs.dimension_config(spark)
    ).filter("sink_table = 'dim_sku_info' and type = 'insert'")
    return routed.select("pk", F.size("data").alias("kept"), map_text(F.col("data")).alias("data"))


@query
def dim_upsert_snapshot(spark, folder):
    """The dimensions of one batch of changes, stored and read back."""
    stored = jobs.dimension_store(scratch_path(spark, "dimensions"))
    jobs.dimension_writer(lambda: inputs.dimension_config(spark), stored)(inputs.dimension_changes(spark, folder), 0)
    return dims.dimension_table(stored.read(spark), "dim_sku_info", "id,sku_name,tm_id,price")


# --- functions --------------------------------------------------------------------------------------


@query
def snake_to_camel(spark, folder):
    return columns.snake_to_camel(inputs.table(spark, folder, "customer"))


@query
def epoch_convert(spark, folder):
    ms = times.wall_millis(F.col("ts"))
    return inputs.table(spark, folder, "events").select("event_id", ms.alias("ms")).select(
        "event_id", "ms",
        times.millis_text(F.col("ms")).alias("shop_text"),
        times.millis_date(F.col("ms")).alias("shop_date"),
        times.text_millis(times.millis_text(F.col("ms"))).alias("text_ms"),
        times.text_millis(times.millis_date(F.col("ms"))).alias("date_ms"),
    )


@query
def ts_ltz_compare(spark, folder):
    rows = inputs.page_rows(spark, folder)
    short = F.concat(F.expr("cast(cast(date_trunc('millisecond', ts) as timestamp_ntz) as string)"), F.lit("Z"))
    full = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("Z"))
    moved = F.concat(
        F.expr("date_format(ts + make_dt_interval(0, 0, 0, (k - 50) / 1000), 'yyyy-MM-dd HH:mm:ss.SSS')"),
        F.lit("Z"),
    )
    return rows.select(
        "event_id", times.compare_instants(short, full).alias("same"),
        times.compare_instants(short, moved).alias("order"),
    )
