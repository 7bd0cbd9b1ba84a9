"""Registered queries: local day, snapshot union, text features and Spark ML models."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from adperf.functions.exprs import AD_KEY, local_day_exact, local_day_fixed
from adperf.functions.metrics import metric_spec, metric_sql
from adperf.functions.windows import anchor_days, effective_days
from adperf.operators import daily as D
from adperf.operators import evaluate as V
from adperf.operators import model as M
from adperf.operators import signals as S
from adperf.operators import text as X
from adperf.operators.boost import Boosting
from adperf.operators.signals import CATALOG_TEXT
from adperf.plans.common import UNIVERSE_FIXTURES, tables, universe, universe_sql
from adperf.plans.finalize import finalize
from adperf.plans.params import ANCHOR, EXCLUDED, FEATURE_WINDOWS, LABEL, SITE_WINDOWS
from adperf.plans.q_eval import FEATS, model_frame, stored_model_frame
from adperf.plans.q_merge import BC, SITE, UBER, WP_COLS, _priced
from adperf.plans.sqlkit import d, final, fixtures, win
from adperf.session import materialize, path_exists, scratch_path, spread
from adperf.sources.files import create_partitioned
from adperf.sources.scans import newest_snapshot

Q: dict = {}
SQL: dict = {}


def register(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


# B24 ---------------------------------------------------------------------------
@register("local_day")
def q_local_day(spark, sf):
    ev = tables(spark, sf).raw("events")
    return finalize(ev.select("event_id", local_day_fixed("ts", ANCHOR).alias("day_fixed"),
                              local_day_exact("ts").alias("day_exact")))


SQL["local_day"] = """select event_id, cast(cast(ts - interval 7 hour as date) as varchar) as day_fixed,
  cast(cast(timezone('America/Los_Angeles', timezone('UTC', ts)) as date) as varchar) as day_exact from events"""


# G2 / B30 ----------------------------------------------------------------------
# The start day and four earlier ones. Labels carry the name of their week count until the snapshots are joined.
SNAPSHOTS = anchor_days(ANCHOR)
SNAPSHOT_WINDOWS = [replace(LABEL, name="l3"), *FEATURE_WINDOWS[1:]]


@register("snapshot_union")
def q_snapshot_union(spark, sf):
    """All windows of five snapshots from daily sums: the first month by month, the others from the months it has; rows with a revenue label."""
    t = tables(spark, sf)
    paths = {day: scratch_path(spark, f"daily-{day}") for day in ("ds", "ad_date")}
    feeds = {"ds": (t.traffic_daily, S.TRAFFIC_MEASURES), "ad_date": (t.attributed_14d, S.ATTR_MEASURES)}
    lo, hi = D.span(SNAPSHOTS, SNAPSHOT_WINDOWS)
    for day, (facts, measures) in feeds.items():
        for anchor in SNAPSHOTS:
            D.add_days(facts, paths[day], day, measures, *D.span([anchor], SNAPSHOT_WINDOWS))
    days = [D.read_days(spark, paths[day], lo, hi) for day in feeds]
    rows = D.renamed_labels(D.anchored_features(*days, anchors=SNAPSHOTS, windows=SNAPSHOT_WINDOWS, excluded=EXCLUDED))
    return finalize(rows.where("sem_rpc_brand_l is not null or sem_rpc_seller_l is not null"))


def _snap_sql():
    """Each snapshot and window by itself, put side by side over the ads with label traffic."""
    ctes, parts = [], []
    for i, anchor in enumerate(SNAPSHOTS):
        joins, cols = [], []
        for w in FEATURE_WINDOWS:
            n = f"s{i}_{w.name}"
            for feed, day, measures in (("traffic_daily", "ds", S.TRAFFIC_MEASURES), ("attributed_14d", "ad_date", S.ATTR_MEASURES)):
                ctes.append(f"{n}_{day} as (select ad_id, source_id, is_mobile, {', '.join(f'sum({m}) as {m}' for m in measures)} from {feed} "
                            f"where {win(day, w, EXCLUDED, anchor.isoformat())} group by all)")
                if w.name != "l" or day != "ds":
                    joins.append(f"left join {n}_{day} on k.ad_id = {n}_{day}.ad_id and k.source_id = {n}_{day}.source_id and k.is_mobile = {n}_{day}.is_mobile")
            t = "k" if w.name == "l" else f"{n}_ds"
            base = {m: f"{t}.{m}" for m in S.TRAFFIC_MEASURES} | {m: f"case when {t}.ad_id is not null then {n}_ad_date.{m} end" for m in S.ATTR_MEASURES}
            cols += metric_sql(metric_spec(("brand", "seller")), base, str(effective_days(anchor, w, EXCLUDED)), "sem_", f"_{w.name}")
        parts.append(f"select {d(anchor)} as snapshot_date, k.ad_id, k.source_id, k.is_mobile, {', '.join(cols)} from s{i}_l_ds k {' '.join(joins)}")
    rows = " union all ".join(f"(select * from ({p}) where sem_rpc_brand_l is not null or sem_rpc_seller_l is not null)" for p in parts)
    return final(f"with {fixtures('traffic_daily', 'attributed_14d')}, {', '.join(ctes)} select * from ({rows})", floats=FEATS, dates=["snapshot_date"])


SQL["snapshot_union"] = _snap_sql()


# C25 / A12 ---------------------------------------------------------------------
@register("text_lookup")
def q_text_lookup(spark, sf):
    """Texts by the cross-reference from the newest of a catalog table's snapshots, found in its list of partitions."""
    T = tables(spark, sf)
    path = scratch_path(spark, "item-text")
    name = f"item_text_{path[-12:]}"
    create_partitioned(spark, name, "item_id bigint, item_name string, item_short_desc string, ts date", ["ts"], path)
    T.item_text_daily.select("item_id", "item_name", "item_short_desc", "ts").write.insertInto(name)
    t = X.text_lookup(universe(T), T.offer_xref, newest_snapshot(spark, name))
    return finalize(t.select("ad_id", "item_id", "item_name", F.length("item_short_desc").alias("desc_chars")))


SQL["text_lookup"] = f"""with {fixtures(*UNIVERSE_FIXTURES, 'item_text_daily')}, {universe_sql()},
j as (select distinct x.ad_id, x.item_id, t.item_name, t.item_short_desc from universe u
  join offer_xref x on u.ad_id = x.ad_id join item_text_daily t on x.item_id = cast(t.item_id as varchar)
  where t.ts = (select max(ts) from item_text_daily)),
r as (select *, row_number() over (partition by ad_id order by item_id, item_name, item_short_desc) as rn from j)
select ad_id, item_id, item_name, cast(length(item_short_desc) as int) as desc_chars from r where rn = 1"""


# H6 terms ----------------------------------------------------------------------
@register("tfidf_terms")
def q_tfidf_terms(spark, sf):
    docs = tables(spark, sf).item_text
    return finalize(X.term_document_frequency(docs, "item_id", "item_short_desc"))


SQL["tfidf_terms"] = final(f"""with {fixtures('item_text')},
w as (select item_id, list_filter(string_split_regex(strip_accents(lower(coalesce(item_short_desc, ''))), '{X.TOKEN_SPLIT}'),
  lambda t: length(t) >= {X.TOKEN_CHARS}) as w from item_text),
g as (select item_id, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
  list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as t from w),
t as (select distinct item_id, unnest(t) as term from g),
n as (select count(*) as n from item_text)
select term, count(*) as df, ln(((select n from n) + 1) / (count(*) + 1)) + 1 as idf from t group by term""", floats=["idf"])


# H7 ----------------------------------------------------------------------------
ENC = ["brand", "department_id"]


@register("label_encode")
def q_label_encode(spark, sf):
    u = materialize(universe(tables(spark, sf)).select(*AD_KEY, *ENC), "universe")  # read for each column's labels and codes
    return finalize(M.label_encode(u, ENC))


SQL["label_encode"] = f"""with {fixtures(*UNIVERSE_FIXTURES)}, {universe_sql()}
select {', '.join(AD_KEY)}, {', '.join(ENC)},
  {', '.join(f"cast(case when {c} is null then (select count(distinct {c}) from universe) else dense_rank() over (partition by {c} is null order by {c}) - 1 end as int) as {c}_idx" for c in ENC)}
from universe"""


# H2 / H3 -----------------------------------------------------------------------
TEXTS = [("item_name", "title_svd", 32), ("item_short_desc", "desc_svd", 64)]

# As in the source's config list: the mobile flag, the ad signal of every window but the label's, catalog, site, bounce and weighted prices, both texts.
GBT_FEATURES = ["is_mobile", *[f for f in FEATS if not f.endswith("_l")], *[f"uber_{c}_w1" for c in UBER if c not in CATALOG_TEXT],
                *[f"{g}_{c}_{w.name}" for w in SITE_WINDOWS for g, cols in (("site", SITE), ("bc", BC)) for c in cols], *WP_COLS,
                *[f"{prefix}_{i}" for _, prefix, k in TEXTS for i in range(k)]]


# The six models: conversion rate, order size and revenue per click, by brand and by seller, each weighted by what it is measured on.
# As in the source, order sizes decide which rows the order size and the revenue models have; label columns without a value count as 0.
SPECS = [M.ModelSpec(f"{kind}_{who}", f"sem_{kind}_{who}_l", weight.format(who), f"source_id = 2 and sem_{bound}_{who}_l between 0 and {most}")
         for who in ("brand", "seller")
         for kind, weight, bound, most in (("convrt", "sem_clicks_l", "convrt", 0.3), ("ordersize", "sem_orders_{}_l", "ordersize", 500), ("rpc", "sem_clicks_l", "ordersize", 500))]
_TRAINED: dict[tuple[str, str], tuple[str, str]] = {}


def kept_paths() -> set[str]:
    """Trained models and text features of this process, which later queries use again."""
    return {p for found in _TRAINED.values() for p in found} | set(_FITTED.values())


def training_frame(spark, sf):
    """The priced feature table with its items' text features and label columns filled with 0."""
    features = _text_features(spark, sf).withColumn("item_id", F.col("item_id").cast("string"))
    return V.label_zero_fill(_priced(tables(spark, sf)).join(features, "item_id", "left"))


def _trained(spark, sf):
    """The binned table and the six models of five folds, from all ads; made once per session and folder, and anew if ``drop_scratch`` has deleted them."""
    key = (spark.conf.get("spark.app.id", "app"), sf)
    if key not in _TRAINED or not all(path_exists(spark, p) for p in _TRAINED[key]):
        frame = V.fold_assign(materialize(training_frame(spark, sf), "model-frame"), AD_KEY, 5)
        table, models = scratch_path(spark, "model-table"), scratch_path(spark, "models")
        M.model_table(frame, SPECS, GBT_FEATURES, AD_KEY).write.parquet(table)
        M.train_models(spark.read.parquet(table), SPECS, Boosting()).write.parquet(models)
        _TRAINED[key] = table, models
    return tuple(spark.read.parquet(p) for p in _TRAINED[key])


@register("gbt_oof")
def q_gbt_oof(spark, sf):
    """Out-of-fold predictions of all six models, one row per ad that any of them has."""
    table, models = _trained(spark, sf)
    return finalize(M.out_of_fold(table, models, SPECS, AD_KEY))


@register("kfold_score")
def q_kfold_score(spark, sf):
    table, models = _trained(spark, sf)
    return finalize(M.kfold_score(table, models, SPECS, AD_KEY))


# H10 ---------------------------------------------------------------------------
@register("model_eval_table")
def q_model_eval_table(spark, sf):
    """Weighted errors by target: each model out of fold, conversion rate x order size, last window's value, own, department and global means."""
    table, models = _trained(spark, sf)
    mf = V.label_zero_fill(stored_model_frame(tables(spark, sf))).join(M.out_of_fold(table, models, SPECS, AD_KEY), AD_KEY, "left")
    targets = [(s.target, s.weight) for s in SPECS]
    metrics = [t.removesuffix("_l") for t, _ in targets]
    mf = V.baseline_dept(mf, metrics, "department_id", [f"dept_{m}" for m in metrics])
    means = V.global_means(mf, [t for t, _ in targets])
    mf = mf.withColumns({**{f"own_{m}": V.baseline_own(mf, m) for m in metrics}, **{f"global_{t}": means[t] for t, _ in targets},
                         **{f"oof_composite_{who}": V.composite_rpc(f"oof_convrt_{who}", f"oof_ordersize_{who}") for who in ("brand", "seller")}})
    pairs = [(s.name, "gbt", s.target, f"oof_{s.name}", s.weight) for s in SPECS]
    pairs += [(f"rpc_{who}", "convrt x ordersize", f"sem_rpc_{who}_l", f"oof_composite_{who}", "sem_clicks_l") for who in ("brand", "seller")]
    for (t, w), m, s in zip(targets, metrics, SPECS, strict=True):
        pairs += [(s.name, "last_window", t, f"{m}_w1", w), (s.name, "own", t, f"own_{m}", w), (s.name, "department", t, f"dept_{m}", w), (s.name, "global", t, f"global_{t}", w)]
    return finalize(V.eval_table(mf, pairs))


# H9 ----------------------------------------------------------------------------
@register("fm_regression")
def q_fm_regression(spark, sf):
    T = tables(spark, sf)
    mf = stored_model_frame(T).join(S.item_brands(T.item_dim), "item_id", "left")
    return finalize(M.fm_regression(mf, AD_KEY, ["item_id", "seller_id", "brand", "department_id", "division_id", "category_id"], "sem_rpc_seller_l"))


# H6 / C26 ----------------------------------------------------------------------
_FITTED: dict[tuple[str, str], str] = {}


def _text_features(spark, sf):
    """Both texts' features of all items; the models are fitted and the items scored once per session and folder."""
    from pyspark.ml.feature import StopWordsRemover

    key = (spark.conf.get("spark.app.id", "app"), sf)
    if key not in _FITTED or not path_exists(spark, _FITTED[key]):
        docs = spread(tables(spark, sf).item_text, "item_id")
        stop = StopWordsRemover.loadDefaultStopWords("english")
        out = docs.select("item_id")
        for column, prefix, k in TEXTS:
            model, rows = X.fit_text_rows(docs, "item_id", column, k, stop_words=stop)
            model = materialize(model, f"text-{column}")
            out = out.join(X.text_features(docs, "item_id", column, model, k, prefix, stop_words=stop, rows=rows), "item_id")
        path = scratch_path(spark, "text-features")
        out.write.parquet(path)
        _FITTED[key] = path
    return spark.read.parquet(_FITTED[key])


@register("text_svd")
def q_text_svd(spark, sf):
    return finalize(_text_features(spark, sf))


@register("text_model_frame")
def q_text_model_frame(spark, sf):
    """The model frame with its items' text features (left join, as the source merges them)."""
    features = _text_features(spark, sf).withColumn("item_id", F.col("item_id").cast("string"))
    return finalize(model_frame(tables(spark, sf)).join(features, "item_id", "left"))
