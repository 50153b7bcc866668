"""The given Parquet tables shaped as the shop's topics, change rows and dimensions.

Every function is a projection (some with a join) over whole tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from retailflow.functions.columns import MONEY
from retailflow.functions.times import wall_millis
from retailflow.operators.ordered import keep_first, keep_latest
from retailflow.plans.windows import ProductDimensions


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# --- logs -------------------------------------------------------------------------------------------


def page_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as flat page rows."""
    events = table(spark, folder, "events").selectExpr(
        "event_id", "ts", "user_id", "event_type",
        "cast(get_json_object(props, '$.k') as int) as k",
    )
    return events.selectExpr(
        "event_id", "ts", "k", "event_type",
        "cast(user_id as string) as mid",
        "case when k >= 10 then cast(user_id as string) end as uid",
        "concat('v', k % 4) as vc", "concat('ch', k % 3) as ch", "concat('ar', user_id % 5) as ar",
        "if(k % 2 = 0, '1', '0') as is_new",
        """case event_type when 'view' then 'home' when 'click' then 'good_detail'
           when 'purchase' then 'trade' when 'signup' then 'mine' else 'error' end as page_id""",
        """case event_type when 'signup' then null when 'click' then 'login'
           when 'view' then 'search' else 'home' end as last_page_id""",
        "cast(k as bigint) as during_time",
    )


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as JSON log text: six kinds of bad text among it, fields no schema names, numbers in quotes or with a part."""
    rows = page_rows(spark, folder).withColumn("ms", wall_millis(F.col("ts")))
    common = F.struct("mid", "uid", "vc", "ch", "ar", "is_new", F.expr("concat('phone ', k % 7)").alias("md"))
    page = F.struct(
        "page_id", "last_page_id", F.col("k").cast("string").alias("item"),
        F.lit("keyword").alias("item_type"), "during_time", F.expr("concat('s', k % 2)").alias("source"),
    )
    kind = F.col("event_type")

    def display(position: int):
        return F.struct((F.col("k") + position).alias("item"), F.lit(position).alias("pos_id"))

    record = F.to_json(F.struct(
        common.alias("common"), page.alias("page"),
        F.when(kind == "signup", F.struct(F.lit("icon").alias("entry"), F.col("k").alias("loading_time")))
        .alias("start"),
        F.when(kind == "view", F.array(display(0), display(1))).alias("displays"),
        F.when(kind == "click", F.array(F.struct(
            F.lit("cart_add").alias("action_id"), F.col("k").alias("item"), F.col("ms").alias("ts")
        ))).alias("actions"),
        F.when(kind == "error", F.struct(F.col("k").alias("error_code"))).alias("err"),
        F.when(F.col("k") % 5 == 0, F.col("event_id").cast("string")).alias("trace"),
        F.col("ms").alias("ts"),
    ))
    written = (
        F.when(F.col("k") % 4 == 1, F.regexp_replace(record, '"ts":([0-9]+)}$', '"ts":"$1"}'))
        .when(F.col("k") % 4 == 2, F.regexp_replace(record, '"during_time":([0-9]+)', '"during_time":$1.5'))
        .when(F.col("k") % 4 == 3, F.regexp_replace(record, '"during_time":([0-9]+)', '"during_time":"$1"'))
        .otherwise(record)
    )
    return rows.select(
        F.when(F.col("k") == 13, F.concat(F.lit("not json "), F.col("event_id")))
        .when(F.col("k") == 26, F.concat(F.lit('{"common":{"mid":"'), F.col("event_id")))
        .when(F.col("k") == 39, F.lit(""))
        .when(F.col("k") == 52, F.concat(F.lit('{"ts":'), F.col("event_id"), F.lit("} trailing")))
        .when(F.col("k") == 65, F.concat(F.lit('{"ts":'), F.col("event_id"), F.lit("} trailing}")))
        .when(F.col("k") == 78, F.concat(*[F.lit('{"ts":'), F.col("event_id"), F.lit("}")] * 2))
        .otherwise(written).alias("value")
    )


# --- keywords ---------------------------------------------------------------------------------------

# Letters written as Han characters, two of them outside the basic block; blanks go, so that words run together.
LETTERS = "abcdefghijklmnopqrstuvwxyz "
HAN = "一丁七万丈三上下不与专且世丘丙业丛东丝丢两严丧个㐀𠀀"


def han_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", F.translate(F.lower("text"), LETTERS, HAN).alias("text"))


def han_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """Words of two to nine characters."""
    found = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")
    words = table(spark, folder, "benchmark").select(found).filter("length(word) between 2 and 9").distinct()
    return words.select(F.translate("word", LETTERS, HAN).alias("word"))


# --- order details ----------------------------------------------------------------------------------


def line_items(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` with one id for order and line; several rows share an id."""
    return table(spark, folder, "lineitem").withColumn(
        "id", F.expr("l_orderkey * 10 + l_linenumber")
    )


ARRIVAL = ["l_partkey", "l_suppkey", "l_extendedprice"]


def latest_items(spark: SparkSession, folder: str) -> DataFrame:
    return keep_latest(line_items(spark, folder), "id", "l_shipdate", ARRIVAL)


def first_items(spark: SparkSession, folder: str) -> DataFrame:
    return keep_first(line_items(spark, folder), "id", ["l_shipdate", *ARRIVAL])


# What the change rows of an item, and those of its activity and coupon, hold of the item besides `ARRIVAL`.
ITEM = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LINK = ["l_orderkey", "l_discount", "l_tax"]


def current_items(spark: SparkSession, folder: str, others: list[str] = ITEM) -> DataFrame:
    """`latest_items` for change rows, which name an item by its id as text.

    The whole row is the greatest of its id, so readers of the same columns ask for the same shuffle, which Spark makes
    once, and a join on the id's text needs no other.
    """
    items = line_items(spark, folder).withColumn("id", F.col("id").cast("string"))
    return items.groupBy("id").agg(F.max(F.struct("l_shipdate", *ARRIVAL, *others)).alias("_item")).select("id", "_item.*")


def detail_rows(spark: SparkSession, folder: str, items: DataFrame) -> DataFrame:
    """Order details with their order's user, province and time."""
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "inner")
    return items.join(placed, F.col("l_orderkey") == F.col("o_orderkey"), "inner").select(
        "id", F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.col("l_linenumber").alias("line"), F.col("l_shipdate").alias("shipped"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("o_custkey").alias("user_id"), F.col("c_nationkey").alias("province_id"),
        F.col("l_quantity").cast("int").alias("sku_num"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("order_price"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("split_total_amount"),
        F.expr(f"""case when l_discount >= 0.05 then
            cast(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2)) as {MONEY})
            end as split_activity_amount"""),
        F.expr(f"""case when l_tax >= 0.04 then
            cast(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)) as {MONEY})
            end as split_coupon_amount"""),
        F.col("o_totalprice").alias("total_price"), F.col("o_orderdate").alias("ts"),
    )


# --- change rows ------------------------------------------------------------------------------------

DATABASE = "shop"


def _changes(rows: DataFrame, source: str, kind: str, data: dict[str, str], old: dict[str, str] | None,
             ts: str) -> DataFrame:
    """Change rows of one source table from SQL expressions; one that names a column takes a column of text.

    The values pass through a generator: a map of bare columns need not be built where only its values are read, and a
    column that goes in is known as the one that comes out, so that its partitioning counts.
    """
    values = {key: expr if expr in rows.columns and rows.schema[expr].dataType.typeName() == "string" else f"_values.{key}"
              for key, expr in data.items()}
    made = ", ".join(f"cast({expr} as string) as {key}" for key, expr in data.items() if values[key] != expr)
    pairs = ", ".join(f"'{key}', {value}" for key, value in values.items())
    before = (
        "map(" + ", ".join(f"'{k}', cast({e} as string)" for k, e in old.items()) + ")"
        if old else "cast(null as map<string, string>)"
    )
    return rows.selectExpr("*", f"explode(array(struct({made}))) as _values").selectExpr(
        f"'{DATABASE}' as `database`", f"'{source}' as `table`", f"{kind} as type",
        f"map({pairs}) as data", f"{before} as old", f"cast({ts} as string) as ts",
    )


def order_changes(spark: SparkSession, folder: str) -> DataFrame:
    """An insert and an update per order; the update moves the status away from 1001."""
    placed = table(spark, folder, "orders").join(
        table(spark, folder, "customer").select("c_custkey", "c_nationkey"),
        F.col("o_custkey") == F.col("c_custkey"), "inner",
    ).selectExpr("*", "explode(array('insert', 'update')) as kind")
    return _changes(
        placed, "order_info", "kind",
        {
            "id": "o_orderkey", "consignee": "concat('Customer ', o_custkey)", "user_id": "o_custkey",
            "total_amount": "cast(o_totalprice as decimal(18,2))",
            "order_status": """if(kind = 'insert', '1001', case o_orderstatus
                when 'F' then '1003' when 'P' then '1005' else '1006' end)""",
            "out_trade_no": "concat('T', o_orderkey)", "order_comment": "o_orderpriority",
            "create_time": "o_orderdate",
            "operate_time": "if(kind = 'insert', null, o_orderdate + interval 1 day)",
            "province_id": "c_nationkey", "original_total_amount": "cast(o_totalprice as decimal(18,2))",
        },
        {"order_status": "if(kind = 'insert', null, '1001')"}, "o_orderdate",
    )


def detail_changes(spark: SparkSession, folder: str) -> DataFrame:
    amount = "cast(l_extendedprice as decimal(18,2))"
    return _changes(
        current_items(spark, folder, ITEM[:5]), "order_detail", "'insert'",
        {
            "id": "id", "order_id": "l_orderkey", "sku_id": "l_partkey",
            "sku_name": "concat('sku ', l_partkey)", "order_price": amount,
            "sku_num": "cast(l_quantity as int)", "create_time": "l_shipdate",
            "source_type": "2400 + l_linenumber", "source_id": "l_suppkey", "split_total_amount": amount,
            "split_activity_amount": f"""case when l_discount >= 0.05
                then cast({amount} * cast(l_discount as decimal(4,2)) as decimal(18,4)) end""",
            "split_coupon_amount": f"""case when l_tax >= 0.04
                then cast({amount} * cast(l_tax as decimal(4,2)) as decimal(18,4)) end""",
        },
        None, "l_shipdate",
    )


def activity_changes(spark: SparkSession, folder: str) -> DataFrame:
    return _changes(
        current_items(spark, folder, LINK).filter("l_discount >= 0.05"), "order_detail_activity", "'insert'",
        {
            "id": "concat('a', id)", "order_id": "l_orderkey", "order_detail_id": "id",
            "activity_id": "l_suppkey", "activity_rule_id": "l_suppkey + 1000", "sku_id": "l_partkey",
            "create_time": "l_shipdate",
        },
        None, "l_shipdate",
    )


def coupon_link_changes(spark: SparkSession, folder: str) -> DataFrame:
    return _changes(
        current_items(spark, folder, LINK).filter("l_tax >= 0.04"), "order_detail_coupon", "'insert'",
        {
            "id": "concat('c', id)", "order_id": "l_orderkey", "order_detail_id": "id",
            "coupon_id": "l_suppkey + 2000", "coupon_use_id": "l_suppkey + 3000", "sku_id": "l_partkey",
            "create_time": "l_shipdate",
        },
        None, "l_shipdate",
    )


def payment_changes(spark: SparkSession, folder: str) -> DataFrame:
    return _changes(
        table(spark, folder, "orders"), "payment_info", "'update'",
        {
            "user_id": "o_custkey", "order_id": "o_orderkey",
            "payment_type": "concat('110', substr(o_orderpriority, 1, 1))",
            "callback_time": "o_orderdate + interval 2 hours",
            "payment_status": "if(o_totalprice > 100000, '1602', '1601')",
        },
        {"payment_status": "'1601'"}, "o_orderdate",
    )


def refund_request_changes(spark: SparkSession, folder: str) -> DataFrame:
    items = current_items(spark, folder).filter("l_returnflag = 'R'").join(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey"),
        F.col("l_orderkey") == F.col("o_orderkey"), "inner",
    )
    return _changes(
        items, "order_refund_info", "'insert'",
        {
            "id": "id", "user_id": "o_custkey", "order_id": "l_orderkey", "sku_id": "l_partkey",
            "refund_type": "if(l_linestatus = 'F', '1501', '1502')", "refund_num": "cast(l_quantity as int)",
            "refund_amount": "cast(l_extendedprice as decimal(18,2))",
            "refund_reason_type": "1300 + l_linenumber",
            "refund_reason_txt": "concat('reason ', l_suppkey)", "create_time": "l_shipdate",
        },
        None, "l_shipdate",
    )


def refund_payment_changes(spark: SparkSession, folder: str) -> DataFrame:
    items = current_items(spark, folder).filter("l_returnflag = 'R' and l_linestatus = 'F'")
    return _changes(
        items, "refund_payment", "'insert'",
        {
            "id": "concat('p', id)", "order_id": "l_orderkey", "sku_id": "l_partkey",
            "payment_type": "1100 + l_linenumber", "callback_time": "l_shipdate + interval 1 day",
            "total_amount": "cast(l_extendedprice as decimal(18,2))",
        },
        None, "l_shipdate",
    )


def cart_changes(spark: SparkSession, folder: str) -> DataFrame:
    """First lines are new cart rows; other lines are updates of a row that held 25 pieces."""
    items = line_items(spark, folder).join(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey"),
        F.col("l_orderkey") == F.col("o_orderkey"), "inner",
    )
    return _changes(
        items, "cart_info", "if(l_linenumber = 1, 'insert', 'update')",
        {
            "id": "id", "user_id": "o_custkey", "sku_id": "l_partkey",
            "cart_price": "cast(l_extendedprice as decimal(18,2))", "sku_num": "cast(l_quantity as int)",
            "sku_name": "concat('sku ', l_partkey)", "is_checked": "l_returnflag",
            "create_time": "l_shipdate",
            "operate_time": "if(l_linenumber = 1, null, l_shipdate + interval 1 hour)",
            "is_ordered": "l_linestatus", "source_type": "2400 + l_linenumber", "source_id": "l_suppkey",
        },
        {"sku_num": "if(l_linenumber = 1, null, '25')"}, "l_shipdate",
    )


def event_changes(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """``events`` as changes of the coupon, favourite, comment or user table."""
    rows = page_rows(spark, folder).withColumn("second", F.expr("cast(date_trunc('second', ts) as timestamp_ntz)"))
    kind = """case event_type when 'view' then 'insert' when 'click' then 'update'
        when 'purchase' then 'update' when 'signup' then 'bootstrap-insert' else 'delete' end"""
    if source == "coupon_use":
        return _changes(
            rows, source, kind,
            {
                "id": "event_id", "coupon_id": "k", "user_id": "mid", "order_id": "event_id + 1",
                "coupon_status": """case event_type when 'click' then '1402' when 'purchase' then '1403'
                    else '1401' end""",
                "get_time": "second", "using_time": "second + interval 1 hour",
                "used_time": "case when event_type = 'purchase' then second + interval 2 hours end",
            },
            {"coupon_status": "if(is_new = '1', '1401', '1402')"}, "ts",
        )
    if source == "favor_info":
        return _changes(
            rows, source, kind,
            {
                "id": "event_id", "user_id": "mid", "sku_id": "k", "is_cancel": "is_new",
                "create_time": "second",
            },
            None, "ts",
        )
    if source == "comment_info":
        return _changes(
            rows, source, kind,
            {
                "id": "event_id", "user_id": "mid", "sku_id": "k", "order_id": "event_id + 1",
                "appraise": "concat('120', substr(vc, 2, 1))", "create_time": "second",
            },
            None, "ts",
        )
    return _changes(rows, "user_info", kind, {"id": "event_id", "create_time": "second"}, None, "ts")


def union_all(*frames: DataFrame) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def order_fact_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The change rows the wide order fact reads, in one frame as on one topic."""
    return union_all(
        order_changes(spark, folder), detail_changes(spark, folder), activity_changes(spark, folder),
        coupon_link_changes(spark, folder), payment_changes(spark, folder),
    )


def refund_fact_changes(spark: SparkSession, folder: str) -> DataFrame:
    return union_all(
        order_changes(spark, folder), refund_request_changes(spark, folder),
        refund_payment_changes(spark, folder),
    )


def dictionary(spark: SparkSession) -> DataFrame:
    """Dictionary of the codes used above; some codes are left out on purpose (2407, 1105, 1203, 1307)."""
    codes = [
        *range(2401, 2407), *range(1101, 1105), *range(1106, 1108), 1200, 1201, 1202, 1501, 1502,
        *range(1301, 1307),
    ]
    values = ", ".join(f"('{code}', 'name of {code}')" for code in codes)
    return spark.sql(f"select * from values {values} as t(dic_code, dic_name)")


# --- dimensions -------------------------------------------------------------------------------------


def provinces(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").selectExpr("n_nationkey as id", "n_name as name")


def product_dimensions(spark: SparkSession, folder: str) -> ProductDimensions:
    parts = table(spark, folder, "part").selectExpr(
        "p_partkey as id", "p_name as spu_id", "p_brand as tm_id",
        "concat(p_type, '-', p_size) as category3_id",
        "concat(p_type, '-', p_size div 10, 'x') as category2_id", "p_type as category1_id",
    )
    return ProductDimensions(
        sku=parts.select("id", "spu_id", "tm_id", "category3_id"),
        spu=parts.selectExpr("spu_id as id", "concat('SPU ', spu_id) as spu_name").distinct(),
        trademark=parts.selectExpr("tm_id as id", "concat('TM ', tm_id) as tm_name").distinct(),
        category3=parts.selectExpr(
            "category3_id as id", "concat('C3 ', category3_id) as name", "category2_id"
        ).distinct(),
        category2=parts.selectExpr(
            "category2_id as id", "concat('C2 ', category2_id) as name", "category1_id"
        ).distinct(),
        category1=parts.selectExpr("category1_id as id", "concat('C1 ', category1_id) as name").distinct(),
    )


def dimension_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change rows of parts (insert and price update), nations (initial load) and regions (no rule)."""
    parts = table(spark, folder, "part").selectExpr("*", "explode(array('insert', 'update')) as kind")
    part_rows = _changes(
        parts, "sku_info", "kind",
        {
            "id": "p_partkey", "sku_name": "p_name", "tm_id": "p_brand", "category": "p_type",
            "price": """if(kind = 'insert', cast(p_retailprice as decimal(18,2)),
                cast(p_retailprice as decimal(18,2)) + 1)""",
        },
        None, "if(kind = 'insert', '1', '2')",
    )
    nation_rows = _changes(
        table(spark, folder, "nation"), "base_province", "'bootstrap-insert'",
        {"id": "n_nationkey", "name": "n_name", "region_id": "n_regionkey"}, None, "'1'",
    )
    region_rows = _changes(
        table(spark, folder, "region"), "base_region", "'insert'",
        {"id": "r_regionkey", "region_name": "r_name"}, None, "'1'",
    )
    return union_all(part_rows, nation_rows, region_rows)


def dimension_config(spark: SparkSession) -> DataFrame:
    return spark.sql(
        """select * from values
           ('sku_info', 'dim_sku_info', 'id,sku_name,tm_id,price', 'id', cast(null as string)),
           ('base_province', 'dim_base_province', 'id,name', '', cast(null as string))
           as t(sourceTable, sinkTable, sinkColumns, sinkPk, sinkExtend)"""
    )
