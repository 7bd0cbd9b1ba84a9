"""Evaluation: target filters, gates, tiers, baselines and weighted errors (ops B16-B20, D20-D31, H1, H5, H8, H10).

Group-level values (department means, global means, total weights) are
computed as small aggregates and attached by join or as scalar subqueries,
never as un-partitioned windows, so no single task ever sees all rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.functions.exprs import c, ratio
from adperf.operators.ordering import ranked_values


# ------------------------------------------------------------- row-level gates
def label_zero_fill(df: DataFrame, label_suffix: str = "_l") -> DataFrame:
    """0-fill label columns, matched by suffix (op B16, S25)."""
    cols = [x for x in df.columns if x.endswith(label_suffix)]
    return df.fillna(0, subset=cols)


def target_filter(target: str, tar: str, source_col: str = "source_id", min_orders: float | None = None) -> Column:
    """Training/validation row filter of a target (op B17).

    The revenue per click has the order size's filter, as in the source;
    ``min_orders`` also asks for so many label orders (the source's older order
    size model learned from three or more).
    """
    low, high, of = (0, 0.3, "convrt") if target == "convrt" else (0, 500, "ordersize")
    ok = (F.col(source_col) == 2) & F.col(f"sem_{of}_{tar}_l").between(low, high)
    return ok if min_orders is None else ok & (F.col(f"sem_orders_{tar}_l") >= min_orders)


def training_gate(df: DataFrame, clicks_col: str = "sem_clicks_l", min_clicks: float = 100.0,
                  label_days: int = 28, require_orders: bool = True) -> DataFrame:
    """Rows usable for training (op B18).

    Either rpc target present; at least ``min_clicks`` label clicks over the
    label window (per-day averages, so the per-day bar is
    ``min_clicks / label_days``: 100/28 for the 4-week label); optionally
    both order counts present.
    """
    cond = (F.col("sem_rpc_brand_l").isNotNull() | F.col("sem_rpc_seller_l").isNotNull()) \
        & (F.col(clicks_col) >= F.lit(min_clicks / label_days))
    if require_orders:
        cond = cond & F.col("sem_orders_brand_l").isNotNull() & F.col("sem_orders_seller_l").isNotNull()
    return df.where(cond)


def confidence_tier(df: DataFrame, tiers: list[str], signal: str = "sem_") -> Column:
    """1, 2, 3... if any ``sem_*_<window>`` of that tier is positive (earlier tier wins), else len+1 (op B19, S20)."""
    expr = None
    for i in reversed(range(len(tiers))):
        cols = [F.col(x) for x in df.columns if x.startswith(signal) and x.endswith(f"_{tiers[i]}")]
        hit = F.greatest(*cols) > 0 if len(cols) > 1 else cols[0] > 0
        expr = F.when(hit, F.lit(i + 1)).otherwise(expr if expr is not None else F.lit(len(tiers) + 1))
    return expr


# ------------------------------------------------------------------ baselines
def baseline_own(df: DataFrame, metric: str, w_a: str = "w1", w_b: str = "w2") -> Column:
    """Own-row mean of two windows; null if either is null (op D20, S22)."""
    return (F.col(f"{metric}_{w_a}") + F.col(f"{metric}_{w_b}")) / 2


def baseline_dept(df: DataFrame, metrics: str | list[str], dept: str, out: str | list[str], w_a: str = "w1",
                  w_b: str = "w2") -> DataFrame:
    """Department mean of each window, halved sum, joined back (op D20, C22).

    All metrics share one per-department aggregate (one row per department,
    broadcast by AQE at run time) and one join.
    """
    metrics = [metrics] if isinstance(metrics, str) else metrics
    out = [out] if isinstance(out, str) else out
    g = df.groupBy(dept).agg(*[((F.avg(f"{m}_{w_a}") + F.avg(f"{m}_{w_b}")) / 2).alias(o)
                               for m, o in zip(metrics, out)])
    return df.join(g, dept, "left")


def baseline_global(df: DataFrame, target: str) -> Column:
    """Global mean of the target as a scalar subquery (op D20); no cross join."""
    return df.select(F.avg(target)).scalar()


def global_means(df: DataFrame, targets: list[str]) -> dict[str, Column]:
    """Global means of several targets from one scalar subquery (one extra pass, not one per target)."""
    s = df.select(F.struct(*[F.avg(t).alias(t) for t in targets])).scalar()
    return {t: s.getField(t) for t in targets}


# -------------------------------------------------------------------- errors
def _valid(y: str, p: str, w: str) -> Column:
    return F.col(y).isNotNull() & F.col(p).isNotNull() & F.col(w).isNotNull()


def weighted_errors(df: DataFrame, y: str, p: str, w: str, log_weight: bool = False) -> list[Column]:
    """Weighted RMSE and MAE over rows with target, prediction and weight (ops D21, D22)."""
    ok = _valid(y, p, w)
    wt = F.log(F.col(w) + F.lit(math.e)) if log_weight else F.col(w)
    err = F.col(y) - F.col(p)
    sw = F.sum(F.when(ok, wt))
    return [F.sqrt(ratio(F.sum(F.when(ok, wt * err * err)), sw)).alias("wrmse"),
            ratio(F.sum(F.when(ok, wt * F.abs(err))), sw).alias("wmae"),
            F.count_if(ok).alias("n")]


def eval_table(df: DataFrame, pairs: list[tuple[str, str, str, str, str]]) -> DataFrame:
    """All (target, model) metric rows in one job (op H10).

    ``pairs`` holds ``(target_name, model_name, y_col, pred_col, weight_col)``;
    the frame is melted with ``stack`` and aggregated by (target, model).
    """
    n = len(pairs)
    args = ", ".join(f"'{t}', '{m}', cast({y} as double), cast({p} as double), cast({w} as double)"
                     for t, m, y, p, w in pairs)
    long = df.selectExpr(f"stack({n}, {args}) as (target, model, y, p, w)")
    return long.groupBy("target", "model").agg(*weighted_errors(long, "y", "p", "w"))


def weighted_error_share(df: DataFrame, y: str, p: str, w: str) -> Column:
    """Row error x weight over the total weight (op D30); total as a scalar subquery."""
    total = df.select(F.sum(F.when(_valid(y, p, w), F.col(w)))).scalar()
    return ratio(F.abs(F.col(y) - F.col(p)) * F.col(w), total)


def threshold_sweep(df: DataFrame, x: str, y: str, cuts: list[float]) -> DataFrame:
    """Count, mean and population variance of ``y`` below / at-or-above each cut of ``x`` (op D23)."""
    arr = F.array(*[F.lit(float(t)) for t in cuts])
    ex = df.where(F.col(x).isNotNull()).select(F.col(x).alias("_x"), F.col(y).alias("_y"), F.explode(arr).alias("cut"))
    side = F.when(F.col("_x") < F.col("cut"), "below").otherwise("above")
    return ex.groupBy("cut", side.alias("side")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("_y").alias("mean"), F.var_pop("_y").alias("var"))


def histogram(df: DataFrame, x: str, bins: int = 100, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width histogram; bounds from scalar subqueries unless given (op D24).

    Bucket 0 holds values below the range, ``bins + 1`` values at or above its top.
    """
    v = F.col(x)
    bounds = df.select(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    lo_c = F.lit(lo) if lo is not None else bounds.getField("lo")
    hi_c = F.lit(hi) if hi is not None else bounds.getField("hi")
    b = (F.when(v < lo_c, 0).when(v >= hi_c, bins + 1)
         .otherwise(F.floor((v - lo_c) / (hi_c - lo_c) * bins).cast("int") + 1))
    return df.where(v.isNotNull()).groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def numeric_summary(df: DataFrame, cols: list[str], quartiles: bool = False) -> DataFrame:
    """Count, mean, sample std, min, max per column, one row each (op D25), in a single pass; quartiles, when asked for, are exact (``ranked_values``)."""
    aggs = []
    for i, x in enumerate(cols):
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).cast("double").alias(f"lo{i}"), F.max(x).cast("double").alias(f"hi{i}")]
    rows = [F.struct(F.lit(x).alias("column"), *[F.col(f"{p}{i}").alias(f) for p, f in zip(["c", "m", "s", "lo", "hi"], ["count", "mean", "std", "min", "max"])])
            for i, x in enumerate(cols)]
    out = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if not quartiles:
        return out
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    found = ranked_values(df, cols, list(shares.values())).groupBy("column").agg(*[F.max(F.when(F.col("share") == q, F.col("value"))).alias(n) for n, q in shares.items()])
    return out.join(found, "column", "left").select(*out.columns, *shares)


def linear_fit(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` (op D26)."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_count(y, x).alias("n"), F.regr_r2(y, x).alias("r2"))


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact distinct count per column (op D27)."""
    return df.agg(*[F.count_distinct(x).alias(f"n_{x}") for x in cols])


def coverage_report(joined: DataFrame, probe: str) -> DataFrame:
    """Missing count and share of a column after a left join (op D28)."""
    miss = F.col(probe).isNull()
    return joined.agg(F.count(F.lit(1)).alias("rows"), F.count_if(miss).alias("missing"),
                      F.avg(miss.cast("double")).alias("missing_share"))


def hierarchy_backoff(df: DataFrame, key: str, gmv: str, clicks: str, min_clicks: float = 250,
                      fallback: float = -999.0) -> DataFrame:
    """Own rpc if clicks > min, else the group's rpc if its clicks > min, else a fallback (op D31)."""
    g = df.groupBy(key).agg(F.sum(gmv).alias("_g_gmv"), F.sum(clicks).alias("_g_clicks"))
    j = df.join(g, key, "left")
    own = ratio(gmv, clicks)
    grp = ratio("_g_gmv", "_g_clicks")
    rpc = (F.when(F.col(clicks) > min_clicks, own).when(F.col("_g_clicks") > min_clicks, grp)
           .otherwise(F.lit(fallback)))
    return j.withColumn("rpc_backoff", rpc).drop("_g_gmv", "_g_clicks")


# ---------------------------------------------------------------- model data
def hash_bucket(cols: list[str], n: int) -> Column:
    """Portable stable bucket: first 8 hex digits of md5 of the key, mod n (ops H1, H8, S18)."""
    key = F.concat_ws("|", *[F.col(x).cast("string") for x in cols])
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(n))


def fold_assign(df: DataFrame, keys: list[str], folds: int = 5) -> DataFrame:
    return df.withColumn("fold", hash_bucket(keys, folds).cast("int"))


def train_test_split(df: DataFrame, keys: list[str], test_tenths: int = 2) -> DataFrame:
    b = hash_bucket(keys, 10)
    return df.withColumn("split", F.when(b < 10 - test_tenths, "train").otherwise("test"))


def composite_rpc(convrt: str | Column, ordersize: str | Column) -> Column:
    """rpc = conversion rate x order size (op H5)."""
    return c(convrt) * c(ordersize)


def type_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column min, max, integrality and the narrowest fitting type (op B29, S21), in a single pass."""
    aggs = []
    for i, x in enumerate(cols):
        v = F.col(x).cast("double")
        finite = ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
        aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
                 (F.count_if(v.isNotNull() & finite & (v != F.floor(v))) == 0).alias(f"int{i}")]
    rows = [F.struct(F.lit(x).alias("column"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"),
                     F.col(f"int{i}").alias("integral")) for i, x in enumerate(cols)]
    out = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    lo, hi = F.col("min"), F.col("max")
    narrow = (F.when(F.col("integral") & (lo >= -128) & (hi <= 127), "tinyint")
              .when(F.col("integral") & (lo >= -32768) & (hi <= 32767), "smallint")
              .when(F.col("integral") & (lo >= -2147483648) & (hi <= 2147483647), "int")
              .when(F.col("integral"), "bigint").otherwise("float"))
    return out.withColumn("narrow_type", narrow)


def narrow_types(df: DataFrame, profile_rows: dict[str, str]) -> DataFrame:
    """Apply a type profile: nullable narrow casts, no 0-fill (S21)."""
    return df.select(*[F.col(x).cast(profile_rows[x]).alias(x) if x in profile_rows else F.col(x) for x in df.columns])
