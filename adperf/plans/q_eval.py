"""Registered queries: feature build and evaluation over the model frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from adperf.functions.exprs import AD_KEY, canonical_id, clip_zero, numeric
from adperf.functions.metrics import base_measures, metric_spec, metric_sql
from adperf.functions.names import remap_windows
from adperf.functions.windows import effective_days
from adperf.operators import evaluate as V
from adperf.operators import signals as S
from adperf.operators.features import sem_features
from adperf.plans.common import UNIVERSE_FIXTURES, metric_names, tables, universe, universe_sql
from adperf.plans.finalize import finalize
from adperf.plans.params import ANCHOR, EXCLUDED, FEATURE_WINDOWS, LABEL, W1
from adperf.plans.q_signals import _attr_sums_sql
from adperf.plans.sqlkit import final, fixtures, win
from adperf.session import materialize

Q: dict = {}
SQL: dict = {}
KEY = "ad_id, source_id, is_mobile"
MF_KEEP = [*AD_KEY, "item_id", "seller_id", "department_id", "division_id", "category_id"]
FEATS = [f"sem_{m}_{w.name}" for w in FEATURE_WINDOWS for m in metric_names()]
FIX = (*UNIVERSE_FIXTURES, "attributed_14d")


def register(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


def model_frame(T, u=None):
    return sem_features(universe(T) if u is None else u, T.traffic_daily, T.attributed_14d, anchor=ANCHOR, windows=FEATURE_WINDOWS,
                        excluded=EXCLUDED, keep=MF_KEEP)


def stored_model_frame(T):
    """The model frame written once to the shared checkpoint folder.

    Evaluation reads it several times (rows, group and global aggregates,
    model fits); the source likewise reads a stored feature table.
    """
    return materialize(model_frame(T))


def model_sql() -> str:
    spec = metric_spec(("brand", "seller"))
    ctes, packs, joins = [], [], []
    for w in FEATURE_WINDOWS:
        n = f"s_{w.name}"
        ctes.append(_attr_sums_sql(w, n))
        base = {b: f"{n}.{b}" for b in base_measures(("brand", "seller"))}
        packs += metric_sql(spec, base, str(effective_days(ANCHOR, w, EXCLUDED)), "sem_", f"_{w.name}")
        joins.append(f"left join {n} on u.ad_id = {n}.ad_id and u.source_id = {n}.source_id and u.is_mobile = {n}.is_mobile")
    return f"""{universe_sql()}, {', '.join(ctes)},
mf as (select u.ad_id, u.source_id, u.is_mobile, u.item_id, u.seller_id, u.department_id, u.division_id, u.category_id,
  {', '.join(packs)}
  from universe u {' '.join(joins)})"""


def mf_with(body: str, floats=(), dates=()) -> str:
    return final(f"with {fixtures(*FIX)}, {model_sql()}\n{body}", floats=floats, dates=dates)


# J3 ----------------------------------------------------------------------------
@register("feature_build")
def q_feature_build(spark, sf):
    return finalize(model_frame(tables(spark, sf)))


SQL["feature_build"] = mf_with("select * from mf", floats=FEATS)


# B16 ---------------------------------------------------------------------------
LABELS = [f for f in FEATS if f.endswith("_l")]


@register("label_zero_fill")
def q_label_zero_fill(spark, sf):
    mf = model_frame(tables(spark, sf)).select(*AD_KEY, *LABELS)
    return finalize(V.label_zero_fill(mf))


SQL["label_zero_fill"] = mf_with(f"select {KEY}, {', '.join(f'coalesce({x}, 0) as {x}' for x in LABELS)} from mf",
                                 floats=LABELS)


# B17 ---------------------------------------------------------------------------
@register("target_filters")
def q_target_filters(spark, sf):
    mf = model_frame(tables(spark, sf))
    flags = [F.coalesce(V.target_filter(t, tar), F.lit(False)).alias(f"ok_{t}_{tar}") for t in ("convrt", "ordersize", "rpc") for tar in ("brand", "seller")]
    flags += [F.coalesce(V.target_filter("ordersize", tar, min_orders=LEAST_ORDERS), F.lit(False)).alias(f"ok_ordersize_min_{tar}") for tar in ("brand", "seller")]
    return finalize(mf.select(*AD_KEY, *flags))


#: Three orders in the label window; label columns are means a day.
LEAST_ORDERS = 3 / effective_days(ANCHOR, LABEL, EXCLUDED)


def _tf_sql(tar):
    size = f"source_id = 2 and sem_ordersize_{tar}_l >= 0 and sem_ordersize_{tar}_l <= 500"
    return f"""coalesce(source_id = 2 and sem_convrt_{tar}_l >= 0 and sem_convrt_{tar}_l <= 0.3, false) as ok_convrt_{tar},
  coalesce({size}, false) as ok_ordersize_{tar}, coalesce({size}, false) as ok_rpc_{tar},
  coalesce({size} and sem_orders_{tar}_l >= cast({LEAST_ORDERS!r} as double), false) as ok_ordersize_min_{tar}"""


SQL["target_filters"] = mf_with(f"select {KEY}, {_tf_sql('brand')}, {_tf_sql('seller')} from mf")



# B18 ---------------------------------------------------------------------------
@register("training_gate")
def q_training_gate(spark, sf):
    mf = model_frame(tables(spark, sf))
    gated = V.training_gate(mf, "sem_clicks_l", 100.0, LABEL.length)
    return finalize(gated.select(*AD_KEY, "sem_clicks_l", "sem_rpc_seller_l"))


SQL["training_gate"] = mf_with(f"""select {KEY}, sem_clicks_l, sem_rpc_seller_l from mf
where (sem_rpc_brand_l is not null or sem_rpc_seller_l is not null) and sem_clicks_l >= {100.0 / LABEL.length!r}
  and sem_orders_brand_l is not null and sem_orders_seller_l is not null""",
                               floats=["sem_clicks_l", "sem_rpc_seller_l"])


# B19 ---------------------------------------------------------------------------
TIERS = ["w1", "w2", "v2"]


@register("confidence_tier")
def q_confidence_tier(spark, sf):
    mf = model_frame(tables(spark, sf))
    return finalize(mf.select(*AD_KEY, V.confidence_tier(mf, TIERS).alias("confidence")))


def _tier_sql():
    parts = []
    for i, t in enumerate(TIERS):
        cols = [f for f in FEATS if f.endswith(f"_{t}")]
        parts.append(f"when greatest({', '.join(cols)}) > 0 then {i + 1}")
    return f"case {' '.join(parts)} else {len(TIERS) + 1} end"


SQL["confidence_tier"] = mf_with(f"select {KEY}, {_tier_sql()} as confidence from mf")


# B20 ---------------------------------------------------------------------------
@register("clip_predictions")
def q_clip_predictions(spark, sf):
    mf = model_frame(tables(spark, sf))
    return finalize(mf.select(*AD_KEY, clip_zero("sem_mpo_seller_w1").alias("pred_clipped")))


SQL["clip_predictions"] = mf_with(
    f"select {KEY}, case when sem_mpo_seller_w1 is not null then greatest(sem_mpo_seller_w1, 0.0) end as pred_clipped from mf",
    floats=["pred_clipped"])


# D20 ---------------------------------------------------------------------------
@register("baseline_own")
def q_baseline_own(spark, sf):
    mf = model_frame(tables(spark, sf))
    return finalize(mf.select(*AD_KEY, *[V.baseline_own(mf, f"sem_{m}_seller").alias(f"pred_{m}_own")
                                         for m in ("convrt", "ordersize", "rpc")]))


SQL["baseline_own"] = mf_with(f"select {KEY}, " + ", ".join(
    f"(sem_{m}_seller_w1 + sem_{m}_seller_w2) / 2 as pred_{m}_own" for m in ("convrt", "ordersize", "rpc")) + " from mf",
    floats=[f"pred_{m}_own" for m in ("convrt", "ordersize", "rpc")])


@register("baseline_dept")
def q_baseline_dept(spark, sf):
    mf = model_frame(tables(spark, sf))
    ms = ("convrt", "ordersize", "rpc")
    out = V.baseline_dept(mf, [f"sem_{m}_seller" for m in ms], "department_id", [f"pred_{m}_dept" for m in ms])
    return finalize(out.select(*AD_KEY, "department_id", *[f"pred_{m}_dept" for m in ("convrt", "ordersize", "rpc")]))


SQL["baseline_dept"] = mf_with(f"""select mf.ad_id, mf.source_id, mf.is_mobile, mf.department_id,
  {', '.join(f'g.pred_{m}_dept' for m in ('convrt', 'ordersize', 'rpc'))}
from mf left join (select department_id, {', '.join(f'(avg(sem_{m}_seller_w1) + avg(sem_{m}_seller_w2)) / 2 as pred_{m}_dept' for m in ('convrt', 'ordersize', 'rpc'))}
  from mf group by department_id) g on mf.department_id = g.department_id""",
    floats=[f"pred_{m}_dept" for m in ("convrt", "ordersize", "rpc")])


@register("baseline_global")
def q_baseline_global(spark, sf):
    mf = stored_model_frame(tables(spark, sf))
    g = V.global_means(mf, [f"sem_{m}_seller_l" for m in ("convrt", "ordersize", "rpc")])
    return finalize(mf.select(*AD_KEY, *[g[f"sem_{m}_seller_l"].alias(f"pred_{m}_global")
                                         for m in ("convrt", "ordersize", "rpc")]))


SQL["baseline_global"] = mf_with(f"select {KEY}, " + ", ".join(
    f"(select avg(sem_{m}_seller_l) from mf) as pred_{m}_global" for m in ("convrt", "ordersize", "rpc")) + " from mf",
    floats=[f"pred_{m}_global" for m in ("convrt", "ordersize", "rpc")])


# D21 / D22 ---------------------------------------------------------------------
def _own_rpc(T, stored: bool = False):
    mf = stored_model_frame(T) if stored else model_frame(T)
    return mf.withColumn("pred_rpc_own", V.baseline_own(mf, "sem_rpc_seller"))


def _werr_sql(log_weight):
    w = "ln(sem_clicks_l + exp(1))" if log_weight else "sem_clicks_l"
    ok = "sem_rpc_seller_l is not null and pred is not null and sem_clicks_l is not null"
    e = "(sem_rpc_seller_l - pred)"
    return mf_with(f"""select sqrt(sum(case when {ok} then {w} * {e} * {e} end) / nullif(sum(case when {ok} then {w} end), 0)) as wrmse,
  sum(case when {ok} then {w} * abs{e} end) / nullif(sum(case when {ok} then {w} end), 0) as wmae,
  count(*) filter (where {ok}) as n
from (select *, (sem_rpc_seller_w1 + sem_rpc_seller_w2) / 2 as pred from mf) q""", floats=["wrmse", "wmae"])


@register("weighted_errors")
def q_weighted_errors(spark, sf):
    df = _own_rpc(tables(spark, sf))
    return finalize(df.agg(*V.weighted_errors(df, "sem_rpc_seller_l", "pred_rpc_own", "sem_clicks_l")))


SQL["weighted_errors"] = _werr_sql(False)


@register("log_weighted_errors")
def q_log_weighted_errors(spark, sf):
    df = _own_rpc(tables(spark, sf))
    return finalize(df.agg(*V.weighted_errors(df, "sem_rpc_seller_l", "pred_rpc_own", "sem_clicks_l", log_weight=True)))


SQL["log_weighted_errors"] = _werr_sql(True)


# H10 ---------------------------------------------------------------------------
TARGET_W = {"convrt": "sem_clicks_l", "ordersize": "sem_orders_seller_l", "rpc": "sem_clicks_l"}


def _pairs():
    out = []
    for m, w in TARGET_W.items():
        for model in ("own", "dept", "global"):
            out.append((m, model, f"sem_{m}_seller_l", f"pred_{m}_{model}", w))
    return out


@register("eval_table")
def q_eval_table(spark, sf):
    mf = stored_model_frame(tables(spark, sf))
    df = V.baseline_dept(mf, [f"sem_{m}_seller" for m in TARGET_W], "department_id", [f"pred_{m}_dept" for m in TARGET_W])
    g = V.global_means(mf, [f"sem_{m}_seller_l" for m in TARGET_W])
    df = df.withColumns({**{f"pred_{m}_own": V.baseline_own(df, f"sem_{m}_seller") for m in TARGET_W},
                         **{f"pred_{m}_global": g[f"sem_{m}_seller_l"] for m in TARGET_W}})
    return finalize(V.eval_table(df, _pairs()))


def _eval_sql():
    preds = []
    for m in TARGET_W:
        preds.append(f"(sem_{m}_seller_w1 + sem_{m}_seller_w2) / 2 as pred_{m}_own")
        preds.append(f"(select avg(sem_{m}_seller_l) from mf) as pred_{m}_global")
        preds.append(f"g.pred_{m}_dept")
    dept = ", ".join(f"(avg(sem_{m}_seller_w1) + avg(sem_{m}_seller_w2)) / 2 as pred_{m}_dept" for m in TARGET_W)
    unions = []
    for t, model, y, p, w in _pairs():
        ok = f"{y} is not null and {p} is not null and {w} is not null"
        e = f"({y} - {p})"
        unions.append(f"""select '{t}' as target, '{model}' as model,
  sqrt(sum(case when {ok} then {w} * {e} * {e} end) / nullif(sum(case when {ok} then {w} end), 0)) as wrmse,
  sum(case when {ok} then {w} * abs{e} end) / nullif(sum(case when {ok} then {w} end), 0) as wmae,
  count(*) filter (where {ok}) as n from p""")
    return mf_with(f""", g as (select department_id, {dept} from mf group by department_id),
p as (select mf.*, {', '.join(preds)} from mf left join g on mf.department_id = g.department_id)
{' union all '.join(unions)}""", floats=["wrmse", "wmae"])


SQL["eval_table"] = _eval_sql()


# D30 ---------------------------------------------------------------------------
@register("weighted_error_share")
def q_weighted_error_share(spark, sf):
    df = _own_rpc(tables(spark, sf), stored=True)
    return finalize(df.select(*AD_KEY, V.weighted_error_share(df, "sem_rpc_seller_l", "pred_rpc_own", "sem_clicks_l")
                              .alias("error_share")))


SQL["weighted_error_share"] = mf_with(f""", p as (select *, (sem_rpc_seller_w1 + sem_rpc_seller_w2) / 2 as pred from mf)
select {KEY}, abs(sem_rpc_seller_l - pred) * sem_clicks_l / nullif((select sum(case when sem_rpc_seller_l is not null
  and pred is not null and sem_clicks_l is not null then sem_clicks_l end) from p), 0) as error_share from p""",
                                      floats=["error_share"])


# D23 ---------------------------------------------------------------------------
CUTS = [1.0, 2.0, 5.0, 10.0, 20.0]


@register("threshold_sweep")
def q_threshold_sweep(spark, sf):
    mf = model_frame(tables(spark, sf))
    return finalize(V.threshold_sweep(mf, "sem_clicks_w1", "sem_convrt_seller_l", CUTS))


SQL["threshold_sweep"] = mf_with(f""", cuts as (select unnest([{', '.join(str(c) for c in CUTS)}]) as cut)
select cut, case when sem_clicks_w1 < cut then 'below' else 'above' end as side, count(*) as n,
  avg(sem_convrt_seller_l) as mean, var_pop(sem_convrt_seller_l) as var
from mf join cuts on true where sem_clicks_w1 is not null group by all""", floats=["cut", "mean", "var"])


# D24 ---------------------------------------------------------------------------
@register("histogram")
def q_histogram(spark, sf):
    return finalize(V.histogram(stored_model_frame(tables(spark, sf)), "sem_rpc_seller_w1", 100))


SQL["histogram"] = mf_with(""", b as (select min(sem_rpc_seller_w1) as lo, max(sem_rpc_seller_w1) as hi from mf)
select case when v < lo then 0 when v >= hi then 101 else cast(floor((v - lo) / (hi - lo) * 100) as int) + 1 end as bucket,
  count(*) as n
from (select sem_rpc_seller_w1 as v from mf where sem_rpc_seller_w1 is not null) x, b group by all""")


# D25 ---------------------------------------------------------------------------
SUMMARY_COLS = ["sem_clicks_w1", "sem_rpc_seller_w1", "sem_convrt_seller_l"]


@register("numeric_summary")
def q_numeric_summary(spark, sf):
    return finalize(V.numeric_summary(model_frame(tables(spark, sf)), SUMMARY_COLS, quartiles=True))


SQL["numeric_summary"] = mf_with("\n" + " union all ".join(
    f"select '{x}' as column, count({x}) as count, avg({x}) as mean, stddev_samp({x}) as std, "
    f"cast(min({x}) as double) as min, cast(max({x}) as double) as max, " + ", ".join(
        f"cast(quantile_cont({x}, {q}) as double) as {name}" for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))) + " from mf"
    for x in SUMMARY_COLS), floats=["mean", "std", "min", "max", "q25", "q50", "q75"])


# D26 ---------------------------------------------------------------------------
@register("linear_fit")
def q_linear_fit(spark, sf):
    return finalize(V.linear_fit(model_frame(tables(spark, sf)), "sem_rpc_seller_l", "sem_clicks_w1"))


SQL["linear_fit"] = mf_with("""select regr_slope(sem_rpc_seller_l, sem_clicks_w1) as slope,
  regr_intercept(sem_rpc_seller_l, sem_clicks_w1) as intercept, cast(regr_count(sem_rpc_seller_l, sem_clicks_w1) as bigint) as n,
  regr_r2(sem_rpc_seller_l, sem_clicks_w1) as r2 from mf""", floats=["slope", "intercept", "r2"])


# D27 ---------------------------------------------------------------------------
DC_COLS = ["item_id", "seller_id", "brand", "department_id", "id_unique_variant"]


@register("distinct_counts")
def q_distinct_counts(spark, sf):
    return finalize(V.distinct_counts(universe(tables(spark, sf)), DC_COLS))


SQL["distinct_counts"] = f"""with {fixtures(*UNIVERSE_FIXTURES)}, {universe_sql()}
select {', '.join(f'count(distinct {x}) as n_{x}' for x in DC_COLS)} from universe"""


# D28 / C26 ---------------------------------------------------------------------
@register("coverage_report")
def q_coverage_report(spark, sf):
    T = tables(spark, sf)
    text = T.item_text.select(F.col("item_id").cast("string").alias("item_id"), "item_name")
    return finalize(V.coverage_report(universe(T).join(text, "item_id", "left"), "item_name"))


SQL["coverage_report"] = final(f"""with {fixtures(*UNIVERSE_FIXTURES, 'item_text')}, {universe_sql()}
select count(*) as rows, count(*) filter (where t.item_name is null) as missing,
  avg(case when t.item_name is null then 1.0 else 0.0 end) as missing_share
from universe u left join item_text t on u.item_id = cast(t.item_id as varchar)""", floats=["missing_share"])


# D31 ---------------------------------------------------------------------------
@register("hierarchy_backoff")
def q_hierarchy_backoff(spark, sf):
    T = tables(spark, sf)
    sums = S.window_sums(T.traffic_daily, AD_KEY, ["gmv", "clicks"], "ds", ANCHOR, W1, EXCLUDED)
    df = universe(T).select(*AD_KEY, "category_id").join(sums, AD_KEY, "inner")
    return finalize(V.hierarchy_backoff(df, "category_id", "gmv", "clicks").select(*AD_KEY, "rpc_backoff"))


SQL["hierarchy_backoff"] = final(f"""with {fixtures(*UNIVERSE_FIXTURES)}, {universe_sql()},
s as (select {KEY}, sum(gmv) as gmv, sum(clicks) as clicks from traffic_daily where {win('ds', W1)} group by all),
d as (select u.ad_id, u.source_id, u.is_mobile, u.category_id, s.gmv, s.clicks from universe u join s
  on u.ad_id = s.ad_id and u.source_id = s.source_id and u.is_mobile = s.is_mobile),
g as (select category_id, sum(gmv) as g_gmv, sum(clicks) as g_clicks from d group by category_id)
select d.ad_id, d.source_id, d.is_mobile, case when d.clicks > 250 then d.gmv / nullif(d.clicks, 0)
  when g.g_clicks > 250 then g.g_gmv / nullif(g.g_clicks, 0) else -999.0 end as rpc_backoff
from d left join g on d.category_id is not distinct from g.category_id""", floats=["rpc_backoff"])


# H1 / H8 -----------------------------------------------------------------------
def _hash_sql(n):
    return f"cast(('0x' || substr(md5(concat_ws('|', ad_id, cast(source_id as varchar), cast(is_mobile as varchar))), 1, 8))::bigint % {n} as int)"


@register("fold_assign")
def q_fold_assign(spark, sf):
    return finalize(V.fold_assign(universe(tables(spark, sf)).select(*AD_KEY), AD_KEY, 5))


SQL["fold_assign"] = f"""with {fixtures(*UNIVERSE_FIXTURES)}, {universe_sql()}
select {KEY}, {_hash_sql(5)} as fold from universe"""


@register("train_test_split")
def q_train_test_split(spark, sf):
    return finalize(V.train_test_split(universe(tables(spark, sf)).select(*AD_KEY), AD_KEY))


SQL["train_test_split"] = f"""with {fixtures(*UNIVERSE_FIXTURES)}, {universe_sql()}
select {KEY}, case when {_hash_sql(10)} < 8 then 'train' else 'test' end as split from universe"""


# H5 ----------------------------------------------------------------------------
@register("composite_rpc")
def q_composite_rpc(spark, sf):
    p = tables(spark, sf).predictions
    return finalize(p.select("ad_id", "is_mobile", "division", V.composite_rpc("pred_convrt", "pred_ordersize").alias("pred_rpc")))


SQL["composite_rpc"] = final(f"""with {fixtures('predictions', 'traffic_daily')}
select ad_id, is_mobile, division, pred_convrt * pred_ordersize as pred_rpc from predictions""", floats=["pred_rpc"])


# B29 ---------------------------------------------------------------------------
PROFILE_COLS = ["impressions", "clicks", "qty", "orders", "gmv"]


@register("type_profile")
def q_type_profile(spark, sf):
    return finalize(V.type_profile(tables(spark, sf).traffic_daily, PROFILE_COLS))


SQL["type_profile"] = final(f"""with {fixtures('traffic_daily')}, p as (
""" + " union all ".join(
    f"select '{x}' as column, min({x}) as min, max({x}) as max, count(*) filter (where {x} is not null and isfinite({x}) and {x} <> floor({x})) = 0 as integral from traffic_daily"
    for x in PROFILE_COLS) + """)
select *, case when integral and min >= -128 and max <= 127 then 'tinyint'
  when integral and min >= -32768 and max <= 32767 then 'smallint'
  when integral and min >= -2147483648 and max <= 2147483647 then 'int'
  when integral then 'bigint' else 'float' end as narrow_type from p""", floats=["min", "max"])


# B14 ---------------------------------------------------------------------------
@register("numeric_coerce")
def q_numeric_coerce(spark, sf):
    u = universe(tables(spark, sf))
    return finalize(u.select(*AD_KEY, numeric(F.col("item_id")).alias("item_num"), numeric(F.col("category_id")).alias("category_num"),
                             numeric(F.col("division_id")).alias("division_num")))


SQL["numeric_coerce"] = final(f"""with {fixtures(*UNIVERSE_FIXTURES)}, {universe_sql()}
select {KEY}, try_cast(item_id as double) as item_num, try_cast(category_id as double) as category_num,
  try_cast(division_id as double) as division_num from universe""", floats=["item_num", "category_num", "division_num"])


# B15 ---------------------------------------------------------------------------
@register("id_canonical")
def q_id_canonical(spark, sf):
    u = universe(tables(spark, sf))
    raw = u.select("ad_id", F.concat(F.lit("00"), "item_id", F.lit(".0")).alias("item_raw"), F.col("id_unique_variant").alias("variant_raw"))
    out = raw.select("ad_id", canonical_id("item_raw").alias("item_id"), canonical_id("variant_raw").alias("variant_id"))
    return finalize(out.where(F.col("item_id").isNotNull() & F.col("variant_id").isNotNull()).distinct())


SQL["id_canonical"] = f"""with {fixtures(*UNIVERSE_FIXTURES)}, {universe_sql()},
r as (select ad_id, cast(try_cast('00' || item_id || '.0' as decimal(38,0)) as varchar) as item_id,
  cast(try_cast(id_unique_variant as decimal(38,0)) as varchar) as variant_id from universe)
select distinct * from r where item_id is not null and variant_id is not null"""


# B12 ---------------------------------------------------------------------------
# A config-style output list (keys, then features).
CONFIG_COLS = ["ad_id", "source_id", "is_mobile", "item_id", "sem_clicks_w1", "sem_convrt_seller_w1",
               "sem_ordersize_seller_w2", "sem_rpc_brand_v2", "sem_ctr_w1"]


@register("config_projection")
def q_config_projection(spark, sf):
    return finalize(model_frame(tables(spark, sf)).select(*CONFIG_COLS))


SQL["config_projection"] = mf_with(f"select {', '.join(CONFIG_COLS)} from mf",
                                   floats=[x for x in CONFIG_COLS if x.startswith("sem_")])


# B13 ---------------------------------------------------------------------------
@register("window_remap")
def q_window_remap(spark, sf):
    return finalize(remap_windows(model_frame(tables(spark, sf)), MF_KEEP))


def _remap_sql():
    from adperf.functions.names import MONTHLY_REMAP, FeatureName
    cols, floats = [], []
    for f in FEATS:
        fn = FeatureName.parse(f)
        if fn and fn.window in MONTHLY_REMAP:
            new = str(FeatureName(fn.signal, fn.metric, MONTHLY_REMAP[fn.window]))
            cols.append(f"{f} as {new}")
            floats.append(new)
    return mf_with(f"select {', '.join(MF_KEEP)}, {', '.join(cols)} from mf", floats=floats)


SQL["window_remap"] = _remap_sql()
