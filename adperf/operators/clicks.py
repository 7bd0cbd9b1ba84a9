"""Click-count windows: first-N-clicks labels and click buckets (ops C8, E1-E5).

All work runs on (ad, day) rows: the daily facts are aggregated first (map-side
combine), so a window partition holds at most one row per day of an ad, however
hot the ad is. Cut-off days are window aggregates over the same partitioning as
the running sum, and the final per-(ad, bucket) aggregation is clustered by a
superset of that key, so the whole chain costs one shuffle after the daily
aggregate. No self-join, no per-threshold query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adperf.functions.exprs import AD_KEY, ad_item
from adperf.functions.metrics import metric_pack
from adperf.functions.windows import DayWindow, as_date, window_filter
from adperf.operators.signals import ATTR_MEASURES, TRAFFIC_MEASURES

MEASURES = TRAFFIC_MEASURES + ATTR_MEASURES


def daily_facts(traffic: DataFrame, attributed: DataFrame, xref: DataFrame, *, anchor: str, window: DayWindow,
                excluded=()) -> DataFrame:
    """One row per (ad, day): traffic sums with that day's attributed measures (S5, S9)."""
    t = (traffic.where(window_filter("ds", anchor, window, excluded)).groupBy(*AD_KEY, "ds")
         .agg(F.max("seller_id").alias("seller_traffic"), *[F.sum(m).alias(m) for m in TRAFFIC_MEASURES]))
    a = (attributed.where(window_filter("ad_date", anchor, window, excluded))
         .groupBy(*AD_KEY, F.col("ad_date").alias("ds")).agg(*[F.sum(m).alias(m) for m in ATTR_MEASURES]))
    x = xref.select("ad_id", F.col("item_id").alias("item_xref"), F.col("seller_id").alias("seller_xref"))
    return (t.join(a, [*AD_KEY, "ds"], "left").join(x, "ad_id", "left")
            .select(*AD_KEY, "ds", F.coalesce("item_xref", ad_item()).alias("item_id"),
                    F.coalesce("seller_xref", "seller_traffic").alias("seller_id"), *MEASURES))


def _running(ascending: bool) -> Window:
    order = F.col("ds").asc() if ascending else F.col("ds").desc()
    return Window.partitionBy(*AD_KEY).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def first_n_cutoff(daily: DataFrame, n: int) -> DataFrame:
    """Earliest day on which running clicks reach ``n`` per ad (op E1); ads never reaching it are absent."""
    cum = F.sum("clicks").over(_running(True))
    return (daily.select(*AD_KEY, "ds", cum.alias("cum_clicks")).where(F.col("cum_clicks") >= n)
            .groupBy(*AD_KEY).agg(F.min("ds").alias("cutoff_ds")))


def label_first_n(daily: DataFrame, *, anchor: str, n: int) -> DataFrame:
    """Sums from the anchor to the first-N cut-off day, as per-day averages and ratios (op E2).

    The cut-off is a window aggregate over the ad, so no join back is needed
    (op C8); total days count from the anchor (S7).
    """
    cum = F.sum("clicks").over(_running(True))
    whole = Window.partitionBy(*AD_KEY)
    df = daily.withColumn("_cum", cum)
    df = df.withColumn("_cut", F.min(F.when(F.col("_cum") >= n, F.col("ds"))).over(whole))
    sums = (df.where(F.col("ds") <= F.col("_cut"))
            .groupBy(*AD_KEY, "item_id", "seller_id")
            .agg((F.datediff(F.max("_cut"), F.lit(as_date(anchor))) + 1).alias("total_days"),
                 *[F.sum(m).alias(m) for m in MEASURES]))
    keep = [*AD_KEY, "item_id", "seller_id", "total_days"]
    return metric_pack(sums, F.col("total_days"), keep=keep)


def reverse_cutoffs(daily: DataFrame, thresholds: list[int]) -> DataFrame:
    """Latest day whose running clicks, counted from the newest day back, reach each threshold (ops E3, E5)."""
    cum = F.sum("clicks").over(_running(False))
    df = daily.select(*AD_KEY, "ds", cum.alias("cum"))
    return df.groupBy(*AD_KEY).agg(*[F.max(F.when(F.col("cum") >= t, F.col("ds"))).alias(f"ds_{t}")
                                     for t in thresholds])


def click_bucket(daily: DataFrame, thresholds: list[int], exclusive_low: bool = False) -> DataFrame:
    """Per-ad sums between consecutive click thresholds, all buckets in one job (ops C8, E4).

    Bucket ``c<j>`` spans ``ds(high) <= day <= ds(low)`` where ``ds(x)`` is the
    reverse cut-off; adjacent buckets share their boundary day (S6) unless
    ``exclusive_low``. Output is long: one row per (ad, bucket).
    """
    whole = Window.partitionBy(*AD_KEY)
    df = daily.withColumn("_cum", F.sum("clicks").over(_running(False)))
    df = df.select("*", *[F.max(F.when(F.col("_cum") >= t, F.col("ds"))).over(whole).alias(f"_c{i}")
                          for i, t in enumerate(thresholds)])
    ds = F.col("ds")
    specs = [F.struct(F.lit(f"c{j}").alias("bucket"), F.col(f"_c{j}").alias("hi"), F.col(f"_c{j + 1}").alias("lo"))
             for j in range(len(thresholds) - 1)]

    def inside(b: Column) -> Column:
        upper = (ds < b["hi"]) if exclusive_low else (ds <= b["hi"])
        return upper & (ds >= b["lo"])

    ex = df.select(*AD_KEY, "item_id", "seller_id", *MEASURES, F.explode(F.filter(F.array(*specs), inside)).alias("b"))
    sums = (ex.groupBy(*AD_KEY, "item_id", "seller_id", F.col("b.bucket").alias("bucket"))
            .agg((F.datediff(F.max("b.hi"), F.max("b.lo")) + 1).alias("total_days"),
                 *[F.sum(m).alias(m) for m in MEASURES]))
    keep = [*AD_KEY, "item_id", "seller_id", "bucket", "total_days"]
    return metric_pack(sums, F.col("total_days"), keep=keep)
