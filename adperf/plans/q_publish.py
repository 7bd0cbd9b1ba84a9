"""Registered queries: publishing, file sources and sinks (round trips under the shared scratch folder)."""

from __future__ import annotations

from pyspark.sql import functions as F

from adperf.operators import publish as P
from adperf.operators import signals as S
from adperf.plans.common import tables
from adperf.plans.finalize import finalize
from adperf.plans.params import ANCHOR, EXCLUDED, W1
from adperf.plans.q_signals import ORDERS_SQL, PAGE_SQL
from adperf.plans.sqlkit import final, fixtures, win
from adperf.session import materialize, scratch_path
from adperf.sources import files as IO

Q: dict = {}
SQL: dict = {}

# Gating lists and partition values of the publish test.
DIVISIONS = ["STANDARD", "MEDIUM", "PROMO"]
OLD_DAY, NEW_DAY = "2001-06-29", "2001-06-30"
BID_COLS = ["ad_id", "source_id", "is_mobile", "division", "super_dept", "clicks_l2wk", "adjusted_rpc", "adj_reason"]
PART_COLS = ["ds", "method", "model", "confidence"]
BID_SCHEMA = ("ad_id string, source_id int, is_mobile int, division string, super_dept string, clicks_l2wk double, "
              "adjusted_rpc double, adj_reason string, ds string, method string, model string, confidence int")


def register(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


def _override(T):
    return P.gated_override(T.bid_table, T.predictions, T.ab_groups, DIVISIONS)


OVERRIDE_SQL = f"""p1 as (select ad_id, is_mobile, division, pred_convrt * pred_ordersize as rpc, pred_convrt, pred_ordersize
  from predictions),
pd as (select * exclude (rn) from (select *, row_number() over (partition by ad_id, is_mobile, division
  order by rpc, pred_convrt, pred_ordersize) as rn from p1) where rn = 1),
pj as (select b.*, pd.rpc, pd.pred_convrt, pd.pred_ordersize from bid_table b left join pd
  on b.ad_id = pd.ad_id and b.is_mobile = pd.is_mobile and b.division = pd.division),
grp as (select distinct adid from ab_groups where grp = '1'),
ok as (select pj.*, coalesce(g.adid is not null and pj.division in ({', '.join(repr(d) for d in DIVISIONS)}), false)
  and pj.rpc is not null and pj.rpc <> 0 as apply from pj left join grp g on pj.ad_id = g.adid),
ovr as (select ad_id, source_id, is_mobile, division, super_dept, clicks_l2wk, rpc, pred_convrt, pred_ordersize,
  adjusted_rpc as old_adjusted_rpc, case when apply then rpc else adjusted_rpc end as adjusted_rpc,
  case when apply then '{{"objective":"Experiment","convrt":' || cast(pred_convrt as varchar) || ',"ordersize":'
    || cast(pred_ordersize as varchar) || '}}' else adj_reason end as adj_reason from ok)"""
PUB_FIX = ("bid_table", "predictions", "ab_groups", "traffic_daily")


def _pub_sql(body, floats=()):
    return final(f"with {fixtures(*PUB_FIX)}, {OVERRIDE_SQL}\n{body}", floats=floats)


# C24 ---------------------------------------------------------------------------
@register("prediction_join")
def q_prediction_join(spark, sf):
    T = tables(spark, sf)
    return finalize(P.prediction_join(T.bid_table, T.predictions))


SQL["prediction_join"] = _pub_sql("select * from pj", floats=["clicks_l2wk", "adjusted_rpc", "rpc", "pred_convrt",
                                                              "pred_ordersize"])


# I1 ----------------------------------------------------------------------------
OVR_FLOATS = ["clicks_l2wk", "adjusted_rpc", "old_adjusted_rpc", "rpc", "pred_convrt", "pred_ordersize"]


@register("gated_override")
def q_gated_override(spark, sf):
    return finalize(_override(tables(spark, sf)))


SQL["gated_override"] = _pub_sql("select * from ovr", floats=OVR_FLOATS)


# B28 ---------------------------------------------------------------------------
@register("reason_json")
def q_reason_json(spark, sf):
    return finalize(_override(tables(spark, sf)).select("ad_id", "source_id", "is_mobile", "adj_reason"))


SQL["reason_json"] = _pub_sql("select ad_id, source_id, is_mobile, adj_reason from ovr")


# D29 ---------------------------------------------------------------------------
@register("modified_count")
def q_modified_count(spark, sf):
    return finalize(P.modified_count(_override(tables(spark, sf))))


SQL["modified_count"] = _pub_sql(
    "select count(*) filter (where old_adjusted_rpc is distinct from adjusted_rpc) as modified, count(*) as rows from ovr")


# A7 / I2 -----------------------------------------------------------------------
def _tier(clicks):
    return F.when(clicks >= 200, 1).when(clicks >= 100, 2).otherwise(3)


@register("publish_dynamic")
def q_publish_dynamic(spark, sf):
    T = tables(spark, sf)
    path = scratch_path(spark, "bids")
    base = T.bid_table.select(*BID_COLS)
    start = base.select("*", F.explode(F.array(F.lit(OLD_DAY), F.lit(NEW_DAY))).alias("ds"), F.lit("LTA").alias("method"),
                        F.lit("warm").alias("model"), _tier(F.col("clicks_l2wk")).alias("confidence"))
    IO.stage_partitioned(start, path, PART_COLS)
    table = spark.read.schema(BID_SCHEMA).parquet(path)
    prod = table.where((F.col("ds") == NEW_DAY) & (F.col("method") == "LTA") & (F.col("model") == "warm"))
    prod = materialize(prod, "bids-prod")  # cut lineage: the publish overwrites the partition it reads
    new = P.gated_override(prod, T.predictions, T.ab_groups, DIVISIONS)
    P.publish_dynamic(new.select(*BID_COLS, *PART_COLS), path, PART_COLS, expected_rows=prod)
    return finalize(spark.read.schema(BID_SCHEMA).parquet(path))


@register("publish_table")
def q_publish_table(spark, sf):
    """As ``publish_dynamic`` into a catalog table: new files beside it, then each partition's location changes."""
    T = tables(spark, sf)
    path = scratch_path(spark, "bid-table")
    name = f"bids_{path[-12:]}"
    IO.create_partitioned(spark, name, BID_SCHEMA, PART_COLS, path)
    days = F.explode(F.array(F.lit(OLD_DAY), F.lit(NEW_DAY)))
    start = T.bid_table.select(*BID_COLS, days.alias("ds"), F.lit("LTA").alias("method"), F.lit("warm").alias("model"), _tier(F.col("clicks_l2wk")).alias("confidence"))
    start.write.insertInto(name)
    fixed = {"ds": NEW_DAY, "method": "LTA", "model": "warm"}
    prod = spark.table(name).where(" and ".join(f"{c} = '{v}'" for c, v in fixed.items()))
    P.publish_table(P.gated_override(prod, T.predictions, T.ab_groups, DIVISIONS), name, fixed, ["confidence"], expected_rows=prod)
    return finalize(spark.table(name))


def _pub_dyn_sql():
    tier = "case when clicks_l2wk >= 200 then 1 when clicks_l2wk >= 100 then 2 else 3 end"
    cols = ", ".join(BID_COLS)
    return _pub_sql(f"""select {cols}, '{OLD_DAY}' as ds, 'LTA' as method, 'warm' as model, {tier} as confidence from bid_table
union all
select {cols}, '{NEW_DAY}' as ds, 'LTA' as method, 'warm' as model, {tier} as confidence from ovr""",
                    floats=["clicks_l2wk", "adjusted_rpc"])


SQL["publish_dynamic"] = _pub_dyn_sql()
SQL["publish_table"] = _pub_dyn_sql()


# A3 ----------------------------------------------------------------------------
@register("csv_dropmalformed")
def q_csv_dropmalformed(spark, sf):
    T = tables(spark, sf)
    path = scratch_path(spark, "csv-bad")
    text = T.bid_table.select("ad_id", F.col("source_id").cast("string").alias("source_id"),
                              F.when(F.col("source_id") == 4, F.lit("n/a"))
                              .otherwise(F.col("clicks_l2wk").cast("string")).alias("clicks_l2wk"))
    IO.csv_write(text, path)
    return finalize(IO.csv_dropmalformed(spark, path, "ad_id string, source_id int, clicks_l2wk double"))


SQL["csv_dropmalformed"] = final(f"""with {fixtures('bid_table', 'traffic_daily')}
select ad_id, source_id, clicks_l2wk from bid_table where source_id <> 4""", floats=["clicks_l2wk"])


# A4 ----------------------------------------------------------------------------
# A config-style column list for the header-less parts.
TSV_NAMES = ["ad_id", "source_id", "is_mobile", "ds", "clicks", "gmv"]
TSV_TYPES = {"source_id": "int", "is_mobile": "int", "ds": "date", "clicks": "double", "gmv": "double"}


@register("tsv_parts")
def q_tsv_parts(spark, sf):
    T = tables(spark, sf)
    path = scratch_path(spark, "tsv")
    rows = T.traffic_daily.where(S.window_filter("ds", ANCHOR, W1, EXCLUDED)).select(*TSV_NAMES)
    IO.write_tsv_parts(rows, path, 4)
    return finalize(IO.tsv_parts(spark, path, TSV_NAMES, TSV_TYPES))


SQL["tsv_parts"] = final(f"""with {fixtures('traffic_daily')}
select {', '.join(TSV_NAMES)} from traffic_daily where {win('ds', W1)}""", floats=["clicks", "gmv"], dates=["ds"])


# A6 / A11 ----------------------------------------------------------------------
@register("stage_partitioned")
def q_stage_partitioned(spark, sf):
    T = tables(spark, sf)
    path = scratch_path(spark, "stage")
    page = S.site_events(T.session_events_nested, anchor=ANCHOR, window=W1, excluded=EXCLUDED)
    IO.stage_partitioned(page, path, ["dt", "action"])
    back = spark.read.schema("session_id string, item_id string, dt date, action string").parquet(path)
    return finalize(back.where(S.window_filter("dt", ANCHOR, W1, EXCLUDED)))


SQL["stage_partitioned"] = final(f"""with {fixtures('session_events')}, {PAGE_SQL}
select * from page""", dates=["dt"])


# A8 ----------------------------------------------------------------------------
@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    T = tables(spark, sf)
    path = scratch_path(spark, "csv")
    df = S.order_rollup(T.order_auth, T.order_items, anchor=ANCHOR, window=W1, excluded=EXCLUDED)
    IO.csv_write(df, path)
    schema = "item_id string, seller_id string, total_orders bigint, total_revenue double, total_cost double, total_margin double"
    return finalize(spark.read.schema(schema).option("header", True).csv(path))


SQL["csv_roundtrip"] = final(f"""with {fixtures('order_auth', 'order_items')}, {ORDERS_SQL}
select * from orders""", floats=["total_revenue", "total_cost", "total_margin"])
