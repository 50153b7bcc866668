"""The registered queries as plain SQL over the given tables, for comparison by value."""

from __future__ import annotations

# --- shared parts -----------------------------------------------------------------------------------

PAGE = """
page as (
  select event_id, ts, k, event_type, cast(user_id as varchar) as mid,
    case when k >= 10 then cast(user_id as varchar) end as uid,
    'v' || (k % 4) as vc, 'ch' || (k % 3) as ch, 'ar' || (user_id % 5) as ar,
    case when k % 2 = 0 then '1' else '0' end as is_new,
    case event_type when 'view' then 'home' when 'click' then 'good_detail'
      when 'purchase' then 'trade' when 'signup' then 'mine' else 'error' end as page_id,
    case event_type when 'signup' then null when 'click' then 'login'
      when 'view' then 'search' else 'home' end as last_page_id,
    cast(k as bigint) as during_time
  from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events)
)"""

LOGS = PAGE + """,
clean as (
  select *, epoch_us(ts) // 1000 as ms, cast(ts as date) as d from page where k not in (13, 26, 39, 52, 65, 78)
),
logs as (
  select * replace (case when is_new = '1' and d <> first_value(case when is_new = '1' then d else d - 1 end)
      over (partition by mid order by ts, event_id) then '0' else is_new end as is_new)
  from clean
)"""

VISITORS = """
visitors as (
  select * exclude (d, previous) from (
    select *, lag(d) over (partition by mid order by ts, event_id) as previous
    from (select *, cast(ts as date) as d from page where last_page_id is null))
  where previous is null or previous <> d
)"""

JUMPS = """
jumps as (
  select * exclude (next_ts, next_last) from (
    select *, lead(ts) over w as next_ts, lead(last_page_id) over w as next_last
    from page window w as (partition by mid order by ts, event_id))
  where last_page_id is null
    and (next_ts is null or next_last is null or next_ts >= ts + interval 4 hours)
)"""

TRAFFIC = f"""{PAGE}, {VISITORS}, {JUMPS},
traffic as (
  select vc, ch, ar, is_new, cast(1 as bigint) as uv, cast(0 as bigint) as sv, cast(0 as bigint) as pv,
    cast(0 as bigint) as duration, cast(0 as bigint) as uj, ts from visitors
  union all
  select vc, ch, ar, is_new, 0, 0, 0, 0, 1, ts from jumps
  union all
  select vc, ch, ar, is_new, 0, case when last_page_id is null then 1 else 0 end, 1,
    coalesce(during_time, 0), 0, ts from page
)"""

_NEWEST = "l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc"
_OLDEST = "l_shipdate, l_partkey, l_suppkey, l_extendedprice"


def _items(name: str, order: str) -> str:
    return f"""
{name} as (
  select *, l_orderkey * 10 + l_linenumber as id from lineitem
  qualify row_number() over (partition by l_orderkey, l_linenumber order by {order}) = 1
)"""


LATEST = _items("items", _NEWEST)
FIRST = _items("items", _OLDEST)

_PRICE = "cast(l_extendedprice as decimal(18,2))"
ACTIVITY_AMOUNT = f"""case when l_discount >= 0.05
  then cast({_PRICE} * cast(l_discount as decimal(4,2)) as decimal(18,4)) end"""
COUPON_AMOUNT = f"""case when l_tax >= 0.04
  then cast({_PRICE} * cast(l_tax as decimal(4,2)) as decimal(18,4)) end"""

PLACED = "placed as (select * from orders join customer on o_custkey = c_custkey)"

DETAILS = f"""{PLACED},
details as (
  select id, l_orderkey as order_id, l_partkey as sku_id, l_returnflag as return_flag,
    o_custkey as user_id, c_nationkey as province_id, cast(l_quantity as integer) as sku_num,
    {_PRICE} as price, {ACTIVITY_AMOUNT} as activity_amount, {COUPON_AMOUNT} as coupon_amount,
    o_totalprice as total_price, o_orderdate as ts
  from items join placed on l_orderkey = o_orderkey
)"""

_CODES = [
    *range(2401, 2407), *range(1101, 1105), *range(1106, 1108), 1200, 1201, 1202, 1501, 1502,
    *range(1301, 1307),
]
DIC = (
    "dic as (select * from (values "
    + ", ".join(f"('{code}', 'name of {code}')" for code in _CODES)
    + ") as t(code, name))"
)

PRODUCTS = """
parts as (
  select p_partkey, p_name as spu_id, p_brand as tm_id, p_type || '-' || p_size as c3,
    p_type || '-' || (p_size // 10) || 'x' as c2, p_type as c1 from part
)"""

# Order states: one insert and one update per order.
STATES = f"""{PLACED},
states as (
  select *, case when kind = 'insert' then '1001' else case o_orderstatus when 'F' then '1003'
      when 'P' then '1005' else '1006' end end as status,
    case when kind = 'update' then '1001' end as old_status,
    case when kind = 'update' then o_orderdate + interval 1 day end as operated
  from placed cross join (values ('insert'), ('update')) as kinds(kind)
)"""


def bucket(width: str, ts: str = "ts") -> str:
    """Start and end text of the epoch-aligned window of ``ts``."""
    start = f"time_bucket(interval '{width}', {ts}, timestamp '1970-01-01')"
    form = "'%Y-%m-%d %H:%M:%S'"
    return (
        f"strftime({start}, {form}) as stt, strftime({start} + interval '{width}', {form}) as edt"
    )


HAN_FROM = "abcdefghijklmnopqrstuvwxyz "
HAN_TO = "一丁七万丈三上下不与专且世丘丙业丛东丝丢两严丧个㐀𠀀"


def _words(text: str) -> str:
    """Letter and digit runs of a text as a list; Han characters only part them."""
    return (f"regexp_extract_all(regexp_replace(lower({text}), '\\p{{Han}}', ' ', 'g'), "
            "'[\\p{L}\\p{N}][\\p{L}\\p{M}\\p{N}]*')")


def _total(expr: str, name: str) -> str:
    return f"cast(sum({expr}) as bigint) as {name}"


def _change_kind(event: str = "event_type") -> str:
    return f"""case {event} when 'view' then 'insert' when 'click' then 'update' when 'purchase' then 'update'
      when 'signup' then 'bootstrap-insert' else 'delete' end"""


EVENT_CHANGES = f"""{PAGE},
changes as (
  select *, {_change_kind()} as kind, date_trunc('second', ts) as second,
    cast(event_id as varchar) as id, cast(k as varchar) as item, cast(event_id + 1 as varchar) as order_id,
    cast(ts as varchar) as ts_text
  from page
)"""

CARTS = f"""{DIC},
carts as (
  select cast(id as varchar) as id, cast(o_custkey as varchar) as user_id,
    cast(l_partkey as varchar) as sku_id, cast({_PRICE} as varchar) as cart_price,
    cast(case when l_linenumber = 1 then cast(l_quantity as integer)
      else cast(l_quantity as integer) - 25 end as varchar) as sku_num,
    'sku ' || l_partkey as sku_name, l_returnflag as is_checked, cast(l_shipdate as varchar) as create_time,
    case when l_linenumber = 1 then null else cast(l_shipdate + interval 1 hour as varchar) end
      as operate_time,
    l_linestatus as is_ordered, cast(null as varchar) as order_time,
    cast(2400 + l_linenumber as varchar) as source_type_id, name as source_type_name,
    cast(l_suppkey as varchar) as source_id
  from (select *, l_orderkey * 10 + l_linenumber as id from lineitem)
  join orders on l_orderkey = o_orderkey
  join dic on code = cast(2400 + l_linenumber as varchar)
  where l_linenumber = 1 or l_quantity > 25
)"""

WIDE = f"""{DIC}, {LATEST}, {STATES},
wide as (
  select cast(id as varchar) as id, cast(l_orderkey as varchar) as order_id,
    cast(l_partkey as varchar) as sku_id, 'sku ' || l_partkey as sku_name,
    cast({_PRICE} as varchar) as order_price, cast(cast(l_quantity as integer) as varchar) as sku_num,
    cast(l_shipdate as varchar) as create_time, code as source_type_id, name as source_type_name,
    cast(l_suppkey as varchar) as source_id, cast({_PRICE} as varchar) as split_total_amount,
    cast({ACTIVITY_AMOUNT} as varchar) as split_activity_amount,
    cast({COUPON_AMOUNT} as varchar) as split_coupon_amount,
    'Customer ' || o_custkey as consignee, cast(null as varchar) as consignee_tel,
    cast(cast(o_totalprice as decimal(18,2)) as varchar) as total_amount, status as order_status,
    cast(o_custkey as varchar) as user_id, cast(null as varchar) as payment_way,
    cast(null as varchar) as delivery_address, o_orderpriority as order_comment,
    'T' || o_orderkey as out_trade_no, cast(null as varchar) as trade_body,
    cast(operated as varchar) as operate_time, cast(null as varchar) as expire_time,
    cast(null as varchar) as process_status, cast(null as varchar) as tracking_no,
    cast(null as varchar) as parent_order_id, cast(c_nationkey as varchar) as province_id,
    cast(null as varchar) as activity_reduce_amount, cast(null as varchar) as coupon_reduce_amount,
    cast(cast(o_totalprice as decimal(18,2)) as varchar) as original_total_amount,
    cast(null as varchar) as feight_fee, cast(null as varchar) as feight_fee_reduce,
    cast(null as varchar) as refundable_time,
    case when l_discount >= 0.05 then 'a' || id end as order_detail_activity_id,
    case when l_discount >= 0.05 then cast(l_suppkey as varchar) end as activity_id,
    case when l_discount >= 0.05 then cast(l_suppkey + 1000 as varchar) end as activity_rule_id,
    case when l_tax >= 0.04 then 'c' || id end as order_detail_coupon_id,
    case when l_tax >= 0.04 then cast(l_suppkey + 2000 as varchar) end as coupon_id,
    case when l_tax >= 0.04 then cast(l_suppkey + 3000 as varchar) end as coupon_use_id,
    kind as type, old_status as old_order_status
  from items join dic on code = cast(2400 + l_linenumber as varchar)
  join states on l_orderkey = o_orderkey
)"""

_DETAIL_COLUMNS = """id, order_id, user_id, sku_id, sku_name, sku_num, order_price, province_id, activity_id,
  activity_rule_id, coupon_id, create_time, source_id, source_type_id, source_type_name,
  split_activity_amount, split_coupon_amount, split_total_amount"""

REFUNDS = f"""{DIC}, {LATEST}, {STATES}"""

DIM_CHANGES = """
routed as (
  select 'dim_sku_info' as sink_table, 'id' as sink_pk, cast(p_partkey as varchar) as pk, kind as type,
    'id=' || p_partkey || ',price=' || (cast(p_retailprice as decimal(18,2))
      + case when kind = 'insert' then 0 else 1 end) || ',sku_name=' || p_name || ',tm_id=' || p_brand
      as data,
    case when kind = 'insert' then '1' else '2' end as ts
  from part cross join (values ('insert'), ('update')) as kinds(kind)
  union all
  select 'dim_base_province', 'id', cast(n_nationkey as varchar), 'bootstrap-insert',
    'id=' || n_nationkey || ',name=' || n_name, '1' from nation
)"""


def _rollup(width: str) -> str:
    return f"""with {TRAFFIC} select {bucket(width)}, vc, ch, ar, is_new as isNew,
      {_total('uv', 'uvCt')}, {_total('sv', 'svCt')}, {_total('pv', 'pvCt')},
      {_total('duration', 'durSum')}, {_total('uj', 'ujCt')} from traffic group by all"""


ORACLE: dict[str, str] = {
    # sources and sinks
    "src_json_table": """select cast(o_orderkey as varchar) as order_id, o_orderstatus as status,
        cast(cast(o_totalprice as decimal(18,2)) as varchar) as total from orders""",
    "src_changelog": f"""with {STATES} select 'shop' as "database", 'order_info' as "table", kind as type,
        cast(o_orderkey as varchar) as id, status as order_status,
        cast(cast(o_totalprice as decimal(18,2)) as varchar) as total_amount, old_status,
        cast(o_orderdate as varchar) as ts from states""",
    "snk_json_roundtrip": "select c_custkey, c_name, c_nationkey, c_mktsegment from customer",
    "snk_upsert_latest": f"""with {STATES} select cast(o_orderkey as varchar) as id,
        status as order_status, cast(o_custkey as varchar) as user_id,
        cast(operated as varchar) as operate_time, cast(o_orderdate as varchar) as ts
        from states where kind = 'update'""",
    "snk_append_once": "select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders",
    "snk_upsert_delete": f"""with {STATES} select cast(o_orderkey as varchar) as id,
        status as order_status, cast(o_custkey as varchar) as user_id,
        cast(operated as varchar) as operate_time, cast(o_orderdate as varchar) as ts
        from states where kind = 'update' and status <> '1005'""",
    "retract_left_join": f"""with {LATEST} select cast(id as varchar) as id, cast(l_orderkey as varchar) as order_id,
        case when l_discount >= 0.05 then 'a' || id end as order_detail_activity_id,
        case when l_discount >= 0.05 then cast(l_suppkey as varchar) end as activity_id from items""",
    "snk_positional_projection": f"""with {LATEST}, {DETAILS},
        totals as (select {bucket('1 day')}, province_id, count(distinct order_id) as n,
          cast(sum(price) as double) as amount from details group by all)
        select stt as p1, edt as p2, province_id as p3, coalesce(n_name, '') as p4, n as p5, amount as p6
        from totals left join nation on n_nationkey = province_id""",
    # logs
    "log_dirty_split": f"""with {PAGE} select case k when 13 then 'not json ' || event_id
          when 26 then '{{"common":{{"mid":"' || event_id when 39 then ''
          when 52 then '{{"ts":' || event_id || '}} trailing' when 65 then '{{"ts":' || event_id || '}} trailing}}'
          else '{{"ts":' || event_id || '}}{{"ts":' || event_id || '}}' end as value
        from page where k in (13, 26, 39, 52, 65, 78)""",
    "log_error": f"""with {LOGS} select mid, is_new, 'md=phone ' || (k % 7) as common_more, page_id, '{{"error_code":' || k || '}}' as err, ms as ts
        from logs where event_type = 'error'""",
    "log_start": f"""with {LOGS} select mid, vc, ch, is_new, 'md=phone ' || (k % 7) as common_more,
          '{{"entry":"icon","loading_time":' || k || '}}' as start, ms as ts
        from logs where event_type = 'signup'""",
    "log_display_explode": f"""with {LOGS} select mid, is_new, 'md=phone ' || (k % 7) as common_more, page_id, cast(k + pos as varchar) as item,
          cast(pos as varchar) as pos_id, ms as ts
        from logs cross join (values (0), (1)) as positions(pos) where event_type = 'view'""",
    "log_action_explode": f"""with {LOGS} select mid, is_new, 'md=phone ' || (k % 7) as common_more, page_id, 'cart_add' as action_id,
          cast(k as varchar) as item, cast(ms as varchar) as action_ts
        from logs where event_type = 'click'""",
    "log_page": f"""with {LOGS} select mid, uid, vc, ch, ar, is_new, page_id, last_page_id,
          cast(k as varchar) as item, 'keyword' as item_type, during_time, ms as ts,
          'md=phone ' || (k % 7) as common_more, 'source=s' || (k % 2) as page_more,
          case when k % 5 = 0 then 'trace=' || event_id else '' end as more
        from logs where event_type <> 'signup'""",
    "is_new_repair": f"""with {PAGE} select event_id, mid, is_new,
          case when is_new = '1' and cast(ts as date) <> first_value(
              case when is_new = '1' then cast(ts as date) else cast(ts as date) - 1 end)
            over (partition by mid order by ts, event_id) then '0' else is_new end as repaired_is_new
        from page""",
    # visits
    "unique_visitor": f"""with {PAGE}, {VISITORS}
        select event_id, mid, vc, ch, ar, is_new, page_id, ts from visitors""",
    "user_jump": f"""with {PAGE}, {JUMPS}
        select event_id, mid, vc, ch, ar, is_new, page_id, ts from jumps""",
    "home_detail_uv_window": f"""with {PAGE}, firsts as (
          select page_id, min(ts) as ts from page where page_id in ('home', 'good_detail')
          group by mid, page_id, cast(ts as date))
        select {bucket('1 hour')}, {_total("case when page_id = 'home' then 1 else 0 end", 'homeUvCt')},
          {_total("case when page_id = 'home' then 0 else 1 end", 'goodDetailUvCt')}
        from firsts group by all""",
    "user_login_window": f"""with {PAGE}, logins as (
          select *, lag(d) over (partition by uid order by ts, event_id) as previous
          from (select *, cast(ts as date) as d from page
            where uid is not null and (last_page_id is null or last_page_id = 'login')))
        select {bucket('1 hour')}, {_total("case when d - previous >= 8 then 1 else 0 end", 'backCt')},
          count(*) as uuCt
        from logins where previous is null or previous <> d group by all""",
    "traffic_union": f"""with {TRAFFIC} select * from traffic""",
    "traffic_rollup_window": _rollup("1 day"),
    "traffic_stream": _rollup("1 hour"),
    # keywords
    "keyword_explode": f"""select doc_id, unnest({_words('text')}) as word from documents""",
    "keyword_window": f"""with words as (
          select timestamp '2024-01-01' + to_seconds(doc_id) as ts, unnest({_words('text')}) as word from documents)
        select {bucket('10 seconds')}, 'search' as source, word as keyword, count(*) as keyword_count
        from words group by all""",
    "keyword_han": f"""with texts as (
          select conv_id, turn, translate(lower(text), '{HAN_FROM}', '{HAN_TO}') as t from conversations),
        vocabulary as (
          select distinct translate(w, '{HAN_FROM}', '{HAN_TO}') as w, length(w) as n
          from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) as w from benchmark)
          where length(w) between 2 and 9),
        runs as (
          select *, row_number() over () as r from (
            select conv_id, turn, unnest(regexp_extract_all(t, '\\p{{Han}}+')) as run from texts)),
        starts as (select r, run, unnest(generate_series(1, length(run))) as i from runs),
        hits as (
          select r, i, n, w from (select r, i, n, substring(run, i, n) as w
            from starts, (select distinct n from vocabulary) where i + n - 1 <= length(run))
          join vocabulary using (w, n)),
        covered as (select distinct r, unnest(generate_series(i, i + n - 1)) as i from hits),
        found as (
          select r, w from hits union all
          select r, substring(run, i, 1) from starts anti join covered using (r, i))
        select conv_id, turn, w as word from found join runs using (r)
        union all select conv_id, turn, unnest({_words('t')}) from texts""",
    # change rows
    "cdc_project": f"""with {STATES} select kind as type, cast(o_orderkey as varchar) as order_id,
          cast(o_custkey as varchar) as user_id, cast(c_nationkey as varchar) as province_id,
          cast(cast(o_totalprice as decimal(18,2)) as varchar) as total_amount,
          cast(o_orderdate as varchar) as create_time from states""",
    "cdc_type_filter": f"""with {EVENT_CHANGES} select kind as type, id, cast(second as varchar) as create_time
        from changes where kind in ('insert', 'update', 'bootstrap-insert')""",
    "date_id": """select cast(o_orderkey as varchar) as id,
          strftime(o_orderdate + interval 1 day, '%Y-%m-%d') as date_id,
          strftime(o_orderdate + interval 1 day, '%Y-%m-%d') as day_text
        from orders join customer on o_custkey = c_custkey""",
    "cart_add": f"with {CARTS} select * from carts",
    "coupon_get": f"""with {EVENT_CHANGES} select id, item as coupon_id, mid as user_id,
          strftime(second, '%Y-%m-%d') as date_id, cast(second as varchar) as get_time, ts_text as ts
        from changes where kind = 'insert'""",
    "coupon_order": f"""with {EVENT_CHANGES} select id, item as coupon_id, mid as user_id, order_id,
          strftime(second + interval 1 hour, '%Y-%m-%d') as date_id,
          cast(second + interval 1 hour as varchar) as order_time, ts_text as ts
        from changes where event_type = 'click' and is_new = '1'""",
    "coupon_pay": f"""with {EVENT_CHANGES} select id, item as coupon_id, mid as user_id, order_id,
          strftime(second + interval 2 hours, '%Y-%m-%d') as date_id,
          cast(second + interval 2 hours as varchar) as payment_time, ts_text as ts
        from changes where event_type = 'purchase'""",
    "favor_add": f"""with {EVENT_CHANGES} select id, mid as user_id, item as sku_id,
          strftime(second, '%Y-%m-%d') as date_id, cast(second as varchar) as create_time, ts_text as ts
        from changes where kind = 'insert' or (kind = 'update' and is_new = '0')""",
    "comment": f"""with {DIC}, {EVENT_CHANGES} select id, mid as user_id, item as sku_id, order_id,
          strftime(second, '%Y-%m-%d') as date_id, cast(second as varchar) as create_time,
          code as appraise_code, name as appraise_name, ts_text as ts
        from changes join dic on code = '120' || substr(vc, 2, 1) where kind = 'insert'""",
    "user_register": f"""with {EVENT_CHANGES} select id as user_id, strftime(second, '%Y-%m-%d') as date_id,
          cast(second as varchar) as create_time, ts_text as ts from changes where kind = 'insert'""",
    "order_wide": f"with {WIDE} select * from wide",
    "order_wide_completed": f"with {WIDE} select * exclude (old_order_status) from wide",
    "order_detail": f"with {WIDE} select {_DETAIL_COLUMNS}, create_time as row_op_ts from wide where type = 'insert'",
    "order_cancel": f"""with {WIDE} select id, order_id, user_id, sku_id, sku_name, province_id, activity_id,
          activity_rule_id, coupon_id, operate_time as cancel_time, source_id, source_type_id,
          source_type_name, sku_num, order_price, split_activity_amount, split_coupon_amount,
          split_total_amount
        from wide where type = 'update' and order_status = '1003'""",
    "pay_detail_suc": f"""with {WIDE}, paid as (
          select cast(o_orderkey as varchar) as order_id, code as payment_type_code,
            name as payment_type_name, cast(o_orderdate + interval 2 hours as varchar) as callback_time
          from orders join dic on code = '110' || substr(o_orderpriority, 1, 1)
          where o_totalprice > 100000)
        select wide.id as order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id,
          activity_rule_id, coupon_id, payment_type_code, payment_type_name, callback_time, source_id,
          source_type_id, source_type_name, sku_num, order_price, split_activity_amount,
          split_coupon_amount, split_total_amount as split_payment_amount, create_time as row_op_ts
        from wide join paid using (order_id) where type = 'insert'""",
    "order_refund": f"""with {REFUNDS} select cast(id as varchar) as id, cast(o_custkey as varchar) as user_id,
          cast(l_orderkey as varchar) as order_id, cast(l_partkey as varchar) as sku_id,
          cast(c_nationkey as varchar) as province_id, strftime(l_shipdate, '%Y-%m-%d') as date_id,
          cast(l_shipdate as varchar) as create_time, types.code as refund_type_code,
          types.name as refund_type_name, reasons.code as refund_reason_type_code,
          reasons.name as refund_reason_type_name, 'reason ' || l_suppkey as refund_reason_txt,
          cast(cast(l_quantity as integer) as varchar) as refund_num,
          cast({_PRICE} as varchar) as refund_amount, cast(l_shipdate as varchar) as ts
        from items join states on l_orderkey = o_orderkey and status = '1005'
        join dic as types on types.code = case when l_linestatus = 'F' then '1501' else '1502' end
        join dic as reasons on reasons.code = cast(1300 + l_linenumber as varchar)
        where l_returnflag = 'R'""",
    "refund_pay_suc": f"""with {REFUNDS}, requests as (
          select l_orderkey, l_partkey, l_quantity from items where l_returnflag = 'R')
        select 'p' || id as id, cast(o_custkey as varchar) as user_id,
          cast(items.l_orderkey as varchar) as order_id, cast(items.l_partkey as varchar) as sku_id,
          cast(c_nationkey as varchar) as province_id, code as payment_type_code,
          name as payment_type_name, strftime(l_shipdate + interval 1 day, '%Y-%m-%d') as date_id,
          cast(l_shipdate + interval 1 day as varchar) as callback_time,
          cast(cast(requests.l_quantity as integer) as varchar) as refund_num,
          cast({_PRICE} as varchar) as refund_amount, cast(l_shipdate as varchar) as ts
        from items join states on items.l_orderkey = o_orderkey and status = '1006'
        join requests on items.l_orderkey = requests.l_orderkey and items.l_partkey = requests.l_partkey
        join dic on code = cast(1100 + l_linenumber as varchar)
        where l_returnflag = 'R' and l_linestatus = 'F'""",
    "dic_lookup": f"""with {DIC} select l_orderkey, l_linenumber, l_partkey, code as source_type,
          name as source_type_name
        from lineitem join dic on code = cast(2400 + l_linenumber as varchar)""",
    # deduplication and trade windows
    "dedup_first": f"""with {FIRST} select id, l_shipdate, l_partkey, l_suppkey, l_quantity,
          l_extendedprice, l_returnflag from items""",
    "dedup_latest": f"""with {LATEST} select id, l_shipdate, l_partkey, l_suppkey, l_quantity,
          l_extendedprice, l_returnflag from items""",
    "order_window": f"""with {FIRST}, {DETAILS}, ranked as (
          select *, row_number() over (partition by user_id, cast(ts as date) order by ts, id) as nth_of_day,
            row_number() over (partition by user_id order by ts, id) as nth from details)
        select {bucket('1 day')}, {_total("case when nth_of_day = 1 then 1 else 0 end", 'orderUniqueUserCount')},
          {_total("case when nth = 1 then 1 else 0 end", 'orderNewUserCount')},
          cast(sum(coalesce(activity_amount, 0)) as double) as orderActivityReduceAmount,
          cast(sum(coalesce(coupon_amount, 0)) as double) as orderCouponReduceAmount,
          cast(sum(sku_num * price) as double) as orderOriginalTotalAmount
        from ranked group by all""",
    "payment_window": f"""with {LATEST}, {DETAILS}, ranked as (
          select *, row_number() over (partition by user_id, cast(ts as date) order by ts, id) as nth_of_day,
            row_number() over (partition by user_id order by ts, id) as nth
          from details where total_price > 100000)
        select {bucket('1 day')}, count(*) as paymentSucUniqueUserCount,
          {_total("case when nth = 1 then 1 else 0 end", 'paymentSucNewUserCount')}
        from ranked where nth_of_day = 1 group by all""",
    "cart_add_uu_window": f"""with {CARTS}, firsts as (
          select min(cast(coalesce(operate_time, create_time) as timestamp)) as ts from carts
          group by user_id, cast(cast(coalesce(operate_time, create_time) as timestamp) as date))
        select {bucket('1 day')}, count(*) as cartAddUuCt from firsts group by all""",
    "user_register_window": f"""with {EVENT_CHANGES} select {bucket('1 hour', 'second')},
          count(*) as registerCt from changes where kind = 'insert' group by all""",
    "province_order_window": f"""with {LATEST}, {DETAILS},
        totals as (select {bucket('1 day')}, province_id, count(distinct order_id) as n,
          cast(sum(price) as double) as amount from details group by all)
        select stt, edt, province_id as provinceId, coalesce(n_name, '') as provinceName,
          n as orderCount, amount as orderAmount
        from totals left join nation on n_nationkey = province_id""",
    "user_spu_order_window": f"""with {FIRST}, {DETAILS}, {PRODUCTS}
        select {bucket('30 days')}, tm_id as trademarkId, 'TM ' || tm_id as trademarkName,
          c1 as category1Id, 'C1 ' || c1 as category1Name, c2 as category2Id, 'C2 ' || c2 as category2Name,
          c3 as category3Id, 'C3 ' || c3 as category3Name, user_id as userId, spu_id as spuId,
          'SPU ' || spu_id as spuName, count(distinct order_id) as orderCount,
          cast(sum(price) as double) as orderAmount
        from details left join parts on p_partkey = sku_id group by all""",
    "refund_window": f"""with {LATEST}, {DETAILS}, {PRODUCTS}
        select {bucket('30 days')}, tm_id as trademarkId, 'TM ' || tm_id as trademarkName,
          c1 as category1Id, 'C1 ' || c1 as category1Name, c2 as category2Id, 'C2 ' || c2 as category2Name,
          c3 as category3Id, 'C3 ' || c3 as category3Name, user_id as userId,
          count(distinct order_id) as refundCount
        from details left join parts on p_partkey = sku_id where return_flag = 'R' group by all""",
    # dimensions
    "dim_lookup_left": """select c_custkey, c_name, s_name as supplier, s_nationkey as supplier_nation
        from customer left join supplier on s_suppkey = c_custkey""",
    "dim_lookup_bucketed": """select l_partkey, count(*) as sold,
          any_value(case when p_size < 5 then null when p_size > 40 then p_name || ' new' else p_name end) as part_name,
          any_value(case when p_size < 5 then null else p_brand end) as brand
        from lineitem left join part on p_partkey = l_partkey group by l_partkey""",
    "snowflake_enrich": f"""with {PRODUCTS} select tm_id as trademarkId, 'TM ' || tm_id as trademarkName,
          c1 as category1Id, 'C1 ' || c1 as category1Name, c2 as category2Id, 'C2 ' || c2 as category2Name,
          c3 as category3Id, 'C3 ' || c3 as category3Name, count(*) as sold
        from lineitem left join parts on p_partkey = l_partkey group by all""",
    "dim_route": f"with {DIM_CHANGES} select * from routed",
    "dim_filter_columns": f"""with {DIM_CHANGES} select pk, 4 as kept, data from routed
        where sink_table = 'dim_sku_info' and type = 'insert'""",
    "dim_upsert_snapshot": """select cast(p_partkey as varchar) as id, p_name as sku_name, p_brand as tm_id,
          cast(cast(p_retailprice as decimal(18,2)) + 1 as varchar) as price from part""",
    # functions
    "snake_to_camel": """select c_custkey as "cCustkey", c_name as "cName", c_nationkey as "cNationkey",
          c_acctbal as "cAcctbal", c_mktsegment as "cMktsegment" from customer""",
    "epoch_convert": """select event_id, epoch_us(ts) // 1000 as ms,
          strftime(ts + interval 8 hours, '%Y-%m-%d %H:%M:%S') as shop_text,
          strftime(ts + interval 8 hours, '%Y-%m-%d') as shop_date,
          epoch_ms(date_trunc('second', ts)) as text_ms,
          epoch_ms(cast(cast(ts + interval 8 hours as date) as timestamp) - interval 8 hours) as date_ms
        from events""",
    "ts_ltz_compare": f"""with {PAGE} select event_id, cast(0 as integer) as same,
          cast(sign(epoch_ms(ts) - epoch_ms(ts + to_milliseconds(k - 50))) as integer) as "order"
        from page""",
}
