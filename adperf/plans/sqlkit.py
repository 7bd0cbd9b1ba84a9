"""Helpers to write the DuckDB oracle SQL: fixture CTEs, window predicates, output casts."""

from __future__ import annotations

from adperf.functions.windows import DayWindow, as_date
from adperf.plans.params import ANCHOR, EXCLUDED
from adperf.sources.fixtures import ATTRIBUTED_MEASURES, CAMPAIGN

# Adapter SQL over the test tables (FIXTURES.md §2), valid in DuckDB.
FIXTURE_SQL: dict[str, str] = {
    "traffic_daily": """select concat(cast(l_partkey as varchar), '_', cast(l_suppkey % 3 as varchar)) as ad_id,
  case when l_linestatus = 'O' then 2 else 4 end as source_id,
  case when l_returnflag = 'R' then 1 else 0 end as is_mobile,
  cast(l_suppkey % 3 as varchar) as seller_id, cast(l_shipdate as date) as ds,
  l_quantity * 20 as impressions, l_quantity as clicks,
  l_extendedprice * l_tax as adspend, cast(l_linenumber as double) as qty,
  cast(l_linenumber % 3 as double) as orders,
  l_extendedprice * (1 - l_discount) as gmv, l_extendedprice * l_discount as cost,
  l_extendedprice * l_tax * 0.5 as estimated_cp, case when l_linenumber = 5 then 0 else 1 end as is_pla,
  case when l_partkey % 3 = 0 then 2 else 1 end as structure_version
from lineitem""",
    "attributed_14d": """select ad_id, source_id, is_mobile, ds as ad_date, orders as orders_brand,
  case when qty > 3 then orders else 0 end as orders_seller,
  gmv * 0.5 as gmv_brand, gmv * 0.25 as gmv_seller, is_pla, structure_version
from traffic_daily where qty <= 5""",
    "offer_xref": """select distinct ad_id, split_part(ad_id, '_', 1) as item_id, seller_id
from traffic_daily where cast(split_part(ad_id, '_', 1) as int) % 7 <> 0""",
    "ad_hierarchy_daily": """select t.ad_id, t.ds, p_type as division_id, concat('S', p_brand) as super_department_id, p_brand as department_id,
  cast(p_size as varchar) as category_id, concat(cast(p_size as varchar), '-', cast(p_partkey % 10 as varchar)) as sub_category_id,
  t.clicks / 50 as impression_share, t.qty / 7 as click_share, t.source_id, t.is_mobile, t.is_pla, t.structure_version
from traffic_daily t join part on p_partkey = cast(split_part(t.ad_id, '_', 1) as bigint)""",
    "item_dim": """select d.ts, cast(p_partkey as varchar) as item_id, concat('P', cast(p_partkey as varchar)) as product_id,
  concat(p_brand, '-', p_type) as brand, cast(p_partkey % 3 as varchar) as seller_id,
  cast(p_partkey % 3 as varchar) as us_seller_id
from part cross join (select date '2001-06-01' as ts union all select date '2001-06-29' as ts) d""",
    "variant_map": """select cast(p_partkey as varchar) as item_id, cast(p_partkey - p_partkey % 4 as varchar) as id_unique_variant
from part where p_partkey % 5 <> 0""",
    "catalog_snapshot": """select cast(l_shipdate as date) as ds, cast(l_partkey as varchar) as item_id,
  cast(l_suppkey % 3 as varchar) as seller_id, p_type as division, concat('S', p_brand) as super_dept, p_brand as dept,
  cast(p_size as varchar) as cat, concat(cast(p_size as varchar), chr(9), '-', cast(p_partkey % 10 as varchar)) as subcat,
  concat('seller ', cast(l_suppkey % 3 as varchar)) as seller_name, concat(p_brand, '-', p_type) as brand_name,
  l_extendedprice / l_quantity as curr_item_price, p_size as num_appr_reviews,
  cast(p_size % 5 as double) as avg_overall_rating, p_retailprice * 0.6 as avg_cost
from lineitem join part on l_partkey = p_partkey""",
    "session_events": """select event_id, concat(cast(user_id as varchar), '_', cast(cast(ts as date) as varchar)) as session_id,
  date '2001-06-01' + cast(day(ts) - 1 as int) as dt,
  regexp_extract(props, '([0-9]+)', 1) as item_id,
  case when event_type = 'view' then 'pageView' when event_type = 'click' then 'addToCart' else event_type end as action,
  case when event_id % 53 = 0 then null when event_id % 47 = 0 then '' when event_id % 43 = 0 then '\\N' else cast(user_id as varchar) end as visitor,
  case when event_id % 11 = 0 then 'BOT' when event_id % 3 = 0 then 'APP' else 'WEB' end as pipeline,
  case when event_id % 13 = 0 then 'searchPage' else 'productPage' end as context
from events""",
    "session_products": """select distinct session_id, dt, action, cast(event_id % 3 as varchar) as seller_id, concat('P', item_id) as product_id
from session_events where event_id % 4 <> 0""",
    "session_stats": """select session_id, dt, count(*) as views,
  case when min(action) = 'addToCart' then 'Paid:SEM' else 'Direct' end as vehicle
from session_events group by session_id, dt""",
    "order_auth": """select l_orderkey as order_nbr, l_linenumber as line_nbr, cast(l_partkey as varchar) as item_id,
  cast(l_shipdate as date) as auth_date, l_extendedprice as amount, l_extendedprice * 0.7 as cost
from lineitem""",
    "order_items": """select l_orderkey as order_nbr, l_linenumber as order_line_nbr, cast(l_partkey as varchar) as item_id,
  cast(l_suppkey % 3 as varchar) as seller_id, p_brand as brand, l_extendedprice as gmv_plcd,
  l_extendedprice * (1 - l_discount) as gmv_order, l_returnflag as fulfilment, cast(o_orderdate as date) as order_date
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "order_visit_chain": """select l_orderkey as order_no, order_date, visit_day,
  cast(datediff('day', date '1970-01-01', visit_day) as bigint) * 86400 + l_linenumber * 3600 as visit_epoch,
  case when l_linenumber = 7 then concat('r', cast(l_orderkey as varchar)) else id_made end as tracking_id, id_made as reflector_id,
  concat('http://shop.example/ip?wl12=', cast(l_partkey as varchar), '_0&selectedsellerid=', cast(l_suppkey % 3 as varchar)) as page_url
from (select *, cast(o_orderdate as date) as order_date, cast(o_orderdate as date) - cast(l_quantity % 20 as int) as visit_day,
  case when l_linenumber <= 3 then concat('222222222', case when l_linenumber = 1 then '27' when l_linenumber = 2 then '22' else '81' end,
         cast(l_partkey as varchar), '_', cast(l_suppkey % 3 as varchar), '_1_1')
       when l_linenumber <= 5 then concat('222222222', '37', cast(l_partkey as varchar), '_1_1')
       else concat('2222222222280', cast(l_partkey as varchar)) end as id_made
  from lineitem join orders on l_orderkey = o_orderkey)""",
    "order_last_ref": """select order_no, order_date, max(visit_day) as created_on, max(reflector_id) as reflector_id
from order_visit_chain where order_no % 3 <> 0 group by order_no, order_date""",
    "promo_links": """select cast(p_partkey as varchar) as item_id, case when p_partkey % 2 = 0 then cast(p_partkey % 3 as varchar) end as seller_id,
  p_size % 10 as event_id, case when p_partkey % 2 = 0 then 2 else 4 end as source_id
from part where p_size % 4 = 0""",
    "bid_table": """select t.ad_id, t.source_id, t.is_mobile, p_type as division, p_brand as super_dept,
  sum(t.clicks) as clicks_l2wk, sum(t.gmv) / sum(t.clicks) as adjusted_rpc, 'base' as adj_reason
from traffic_daily t join part on p_partkey = cast(split_part(t.ad_id, '_', 1) as bigint)
group by t.ad_id, t.source_id, t.is_mobile, p_type, p_brand""",
    "predictions": """select ad_id, is_mobile, division, (clicks_l2wk % 7) / 100 as pred_convrt, 10 + clicks_l2wk % 90 as pred_ordersize
from bid_table where source_id = 2""",
    "ab_groups": """select distinct ad_id as adid, case when length(ad_id) % 2 = 0 then '1' else '0' end as grp from bid_table""",
    "item_text": """select doc_id as item_id, split_part(text, '.', 1) as item_name, text as item_short_desc from documents""",
    "item_text_daily": """select item_id, item_name, item_short_desc, date '2001-06-29' as ts from item_text
union all select item_id, concat('old ', item_name), item_short_desc, date '2001-06-01' from item_text""",
    "channel_params": """select 1 as customer_id, '^2{9}[0-9]+$' as id_regex, 10 as channel_pos, 10 as adid_length""",
    "ad_item_xref": """select cast(concat('80', cast(p_partkey as varchar)) as bigint) as legacy_id, cast(p_partkey as varchar) as item_id from part""",
    "traffic_flat": f"""select ds as day, source_id, is_mobile, is_pla, structure_version, {CAMPAIGN} as campaign, ad_id, split_part(ad_id, '_', 1) as item_id, seller_id,
  adspend, clicks, impressions, orders, gmv as revenue, concat('acct', seller_id) as account
from traffic_daily""",
    "seller_accounts": """select distinct account, seller_id from traffic_flat where seller_id <> '0'""",
    "attributed_gmv": f"""select split_part(ad_id, '_', 1) as item_id,
  case when cast(split_part(ad_id, '_', 1) as int) % 11 <> 0 then split_part(ad_id, '_', 2) end as seller_id,
  ad_id, source_id, is_mobile, is_pla, structure_version, case when {CAMPAIGN} = 'all' then 1 else 0 end as is_target_all, ad_date,
  {', '.join(f'{e} as {m}' for m, e in ATTRIBUTED_MEASURES.items())}
from attributed_14d group by ad_id, source_id, is_mobile, is_pla, structure_version, ad_date""",
}

FIXTURE_DEPS: dict[str, list[str]] = {
    "attributed_14d": ["traffic_daily"], "offer_xref": ["traffic_daily"], "ad_hierarchy_daily": ["traffic_daily"],
    "session_products": ["session_events"], "session_stats": ["session_events"],
    "order_last_ref": ["order_visit_chain"], "bid_table": ["traffic_daily"], "predictions": ["bid_table"],
    "ab_groups": ["bid_table"], "traffic_flat": ["traffic_daily"], "seller_accounts": ["traffic_flat"],
    "attributed_gmv": ["attributed_14d"], "item_text_daily": ["item_text"],
}


def fixtures(*names: str) -> str:
    """``WITH`` clause (without the keyword) defining the named adapters and their dependencies."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in FIXTURE_DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return ",\n".join(f"{n} as ({FIXTURE_SQL[n]})" for n in order)


def d(x) -> str:
    return f"date '{as_date(x).isoformat()}'"


def win(col: str, w: DayWindow, excluded=EXCLUDED, anchor: str = ANCHOR) -> str:
    """SQL twin of ``window_filter``."""
    lo, hi = w.bounds(as_date(anchor))
    s = f"({col} between {d(lo)} and {d(hi)}"
    if excluded:
        s += f" and {col} not in ({', '.join(d(x) for x in excluded)})"
    return s + ")"


def final(body: str, floats=(), dates=()) -> str:
    """Wrap an oracle body so doubles come out as FLOAT and dates as text, like ``finalize``."""
    reps = [f"cast({c} as float) as {c}" for c in floats] + [f"cast({c} as varchar) as {c}" for c in dates]
    if not reps:
        return body
    return f"select * replace ({', '.join(reps)}) from (\n{body}\n) q"
