"""Registered queries: click-count windows, top-N, sorted export, de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from adperf.functions.exprs import AD_KEY
from adperf.functions.metrics import base_measures, metric_spec, metric_sql
from adperf.operators import clicks as K
from adperf.operators import ordering as O
from adperf.operators import signals as S
from adperf.plans.common import UNIVERSE_FIXTURES, metric_names, tables, universe, universe_sql
from adperf.plans.finalize import finalize
from adperf.plans.params import ANCHOR, CLICK_CUTS, EXCLUDED, FIRST_N, HISTORY, LABEL, W1
from adperf.plans.sqlkit import d, final, fixtures, win

Q: dict = {}
SQL: dict = {}
KEY = "ad_id, source_id, is_mobile"


def register(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


def _daily(T, w):
    return K.daily_facts(T.traffic_daily, T.attributed_14d, T.offer_xref, anchor=ANCHOR, window=w, excluded=EXCLUDED)


def daily_sql(w) -> str:
    t = ", ".join(f"sum({m}) as {m}" for m in S.TRAFFIC_MEASURES)
    a = ", ".join(f"sum({m}) as {m}" for m in S.ATTR_MEASURES)
    return f"""td as (select {KEY}, ds, max(seller_id) as seller_traffic, {t} from traffic_daily where {win('ds', w)}
  group by {KEY}, ds),
tad as (select {KEY}, ad_date, {a} from attributed_14d where {win('ad_date', w)} group by {KEY}, ad_date),
daily as (select td.ad_id, td.source_id, td.is_mobile, td.ds, coalesce(x.item_id, split_part(td.ad_id, '_', 1)) as item_id,
  coalesce(x.seller_id, td.seller_traffic) as seller_id, {', '.join('td.' + m for m in S.TRAFFIC_MEASURES)},
  {', '.join('tad.' + m for m in S.ATTR_MEASURES)}
  from td left join tad on td.ad_id = tad.ad_id and td.source_id = tad.source_id and td.is_mobile = tad.is_mobile
    and td.ds = tad.ad_date
  left join offer_xref x on td.ad_id = x.ad_id)"""


def _pack(alias, days):
    base = {b: f"{alias}.{b}" for b in base_measures(("brand", "seller"))}
    return ",\n  ".join(metric_sql(metric_spec(("brand", "seller")), base, days))


SUMS = ", ".join(f"sum({m}) as {m}" for m in K.MEASURES)
FIX = ("traffic_daily", "attributed_14d", "offer_xref")


# E1 ----------------------------------------------------------------------------
@register("first_n_cutoff")
def q_first_n_cutoff(spark, sf):
    return finalize(K.first_n_cutoff(_daily(tables(spark, sf), LABEL), FIRST_N))


SQL["first_n_cutoff"] = final(f"""with {fixtures(*FIX)}, {daily_sql(LABEL)},
c as (select {KEY}, ds, sum(clicks) over (partition by {KEY} order by ds rows between unbounded preceding and current row) as cum
  from daily)
select {KEY}, min(ds) as cutoff_ds from c where cum >= {FIRST_N} group by {KEY}""", dates=["cutoff_ds"])


# E2 / C8 -----------------------------------------------------------------------
@register("label_first_n")
def q_label_first_n(spark, sf):
    return finalize(K.label_first_n(_daily(tables(spark, sf), LABEL), anchor=ANCHOR, n=FIRST_N))


SQL["label_first_n"] = final(f"""with {fixtures(*FIX)}, {daily_sql(LABEL)},
c as (select {KEY}, ds, sum(clicks) over (partition by {KEY} order by ds rows between unbounded preceding and current row) as cum
  from daily),
cut as (select {KEY}, min(ds) as cutoff from c where cum >= {FIRST_N} group by {KEY}),
s as (select d.ad_id, d.source_id, d.is_mobile, d.item_id, d.seller_id,
  cast(datediff('day', {d(ANCHOR)}, max(cut.cutoff)) + 1 as int) as total_days, {SUMS}
  from daily d join cut on d.ad_id = cut.ad_id and d.source_id = cut.source_id and d.is_mobile = cut.is_mobile
    and d.ds <= cut.cutoff
  group by d.ad_id, d.source_id, d.is_mobile, d.item_id, d.seller_id)
select s.ad_id, s.source_id, s.is_mobile, s.item_id, s.seller_id, s.total_days, {_pack('s', 's.total_days')} from s""",
                               floats=metric_names())


# E3 / E5 -----------------------------------------------------------------------
@register("reverse_cutoffs")
def q_reverse_cutoffs(spark, sf):
    return finalize(K.reverse_cutoffs(_daily(tables(spark, sf), HISTORY), CLICK_CUTS))


REV_SQL = f"""c as (select *, sum(clicks) over (partition by {KEY} order by ds desc rows between unbounded preceding and current row) as cum
  from daily)"""
SQL["reverse_cutoffs"] = final(f"""with {fixtures(*FIX)}, {daily_sql(HISTORY)}, {REV_SQL}
select {KEY}, {', '.join(f'max(case when cum >= {t} then ds end) as ds_{t}' for t in CLICK_CUTS)}
from c group by {KEY}""", dates=[f"ds_{t}" for t in CLICK_CUTS])


# E4 / C8 -----------------------------------------------------------------------
@register("click_bucket")
def q_click_bucket(spark, sf):
    return finalize(K.click_bucket(_daily(tables(spark, sf), HISTORY), CLICK_CUTS))


def _bucket_sql():
    cuts = ", ".join(f"max(case when cum >= {t} then ds end) as c{i}" for i, t in enumerate(CLICK_CUTS))
    parts = []
    for j in range(len(CLICK_CUTS) - 1):
        parts.append(f"""select d.ad_id, d.source_id, d.is_mobile, d.item_id, d.seller_id, 'c{j}' as bucket,
  cast(datediff('day', max(k.c{j + 1}), max(k.c{j})) + 1 as int) as total_days, {SUMS}
  from daily d join k on d.ad_id = k.ad_id and d.source_id = k.source_id and d.is_mobile = k.is_mobile
  where d.ds <= k.c{j} and d.ds >= k.c{j + 1}
  group by d.ad_id, d.source_id, d.is_mobile, d.item_id, d.seller_id""")
    union = "\nunion all\n".join(parts)
    return final(f"""with {fixtures(*FIX)}, {daily_sql(HISTORY)}, {REV_SQL},
k as (select {KEY}, {cuts} from c group by {KEY}),
s as ({union})
select s.ad_id, s.source_id, s.is_mobile, s.item_id, s.seller_id, s.bucket, s.total_days, {_pack('s', 's.total_days')}
from s""", floats=metric_names())


SQL["click_bucket"] = _bucket_sql()

# F1 ----------------------------------------------------------------------------
# Fixed value: the source's N.
TOP_N = 500_000


def _signal(T):
    return S.ad_signal_attr(universe(T), T.traffic_daily, T.attributed_14d, anchor=ANCHOR, window=W1,
                            excluded=EXCLUDED)


def _signal_sql():
    from adperf.plans.q_signals import _attr_sums_sql, _pack_sql
    from adperf.functions.windows import effective_days
    return f"""{universe_sql()}, {_attr_sums_sql(W1)},
sig as (select u.ad_id, u.source_id, u.is_mobile, u.item_id, u.seller_id,
  {_pack_sql('s', ('brand', 'seller'), effective_days(ANCHOR, W1, EXCLUDED))}
  from universe u left join sums s on u.ad_id = s.ad_id and u.source_id = s.source_id and u.is_mobile = s.is_mobile)"""


def order_key():
    return [F.col("clicks").desc_nulls_last(), F.col("ad_id").asc(), F.col("source_id").asc(), F.col("is_mobile").asc()]

ORDER_SQL = "clicks desc nulls last, ad_id, source_id, is_mobile"


@register("topn_clicks")
def q_topn_clicks(spark, sf):
    sig = _signal(tables(spark, sf))
    return finalize(O.topn(sig.select(*AD_KEY, "item_id", "clicks", "convrt_seller"), TOP_N, order_key()))


SQL["topn_clicks"] = final(f"""with {fixtures(*UNIVERSE_FIXTURES, 'attributed_14d')}, {_signal_sql()}
select ad_id, source_id, is_mobile, item_id, clicks, convrt_seller from sig order by {ORDER_SQL} limit {TOP_N}""",
                           floats=["clicks", "convrt_seller"])


# F2 ----------------------------------------------------------------------------
@register("topn_complete")
def q_topn_complete(spark, sf):
    sig = _signal(tables(spark, sf))
    nulls = O.null_count(metric_names())
    out = sig.select(*AD_KEY, nulls.alias("n_null"))
    return finalize(O.topn(out, TOP_N, [F.col("n_null").asc(), *[F.col(k).desc() for k in AD_KEY]]))


SQL["topn_complete"] = f"""with {fixtures(*UNIVERSE_FIXTURES, 'attributed_14d')}, {_signal_sql()},
n as (select ad_id, source_id, is_mobile, cast({' + '.join(f'(case when {m} is null then 1 else 0 end)' for m in metric_names())} as int) as n_null from sig)
select * from n order by n_null, ad_id desc, source_id desc, is_mobile desc limit {TOP_N}"""


# F3 ----------------------------------------------------------------------------
@register("sorted_export")
def q_sorted_export(spark, sf):
    sig = _signal(tables(spark, sf)).select(*AD_KEY, "clicks", "rpc_seller")
    return finalize(O.sorted_export(sig, order_key()))


SQL["sorted_export"] = final(f"""with {fixtures(*UNIVERSE_FIXTURES, 'attributed_14d')}, {_signal_sql()}
select ad_id, source_id, is_mobile, clicks, rpc_seller from sig order by {ORDER_SQL}""", floats=["clicks", "rpc_seller"])


# F4 ----------------------------------------------------------------------------
@register("dedup_first")
def q_dedup_first(spark, sf):
    t = tables(spark, sf).traffic_daily.select(*AD_KEY, "ds", "clicks", "gmv")
    return finalize(O.dedup_first(t, AD_KEY, ["ds", "clicks", "gmv"]))


SQL["dedup_first"] = final(f"""with {fixtures('traffic_daily')},
r as (select {KEY}, ds, clicks, gmv, row_number() over (partition by {KEY} order by ds, clicks, gmv) as rn from traffic_daily)
select {KEY}, ds, clicks, gmv from r where rn = 1""", floats=["clicks", "gmv"], dates=["ds"])
