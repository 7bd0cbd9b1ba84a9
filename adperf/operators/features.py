"""Snapshot feature build: every window of a signal in one scan (ops J3, B30, G2).

The source runs one query per (signal, window, anchor) and rescans the same
daily facts each time. Here each signal is one scan over the union span of
its windows: the windows' ends cut the days into disjoint segments, a row is
summed into its segment, and a window is the sum of its segments; several
anchors are handled in the same scan by exploding the anchors a row belongs to.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.functions.exprs import AD_KEY
from adperf.functions.metrics import base_measures, metric_columns, metric_spec
from adperf.functions.windows import DayWindow, as_date, effective_days, segments, span_filter, window_filter
from adperf.operators.signals import ATTR_MEASURES, TRAFFIC_MEASURES


def day_segment(back: Callable[[int, int], Column], windows: list[DayWindow]) -> Column:
    """Number of the segment a day lies in, null outside all windows; ``back(near, far)`` tells whether it lies so far back."""
    out = F.lit(None).cast("int")
    for i, (near, far) in enumerate(segments(windows)):
        out = F.when(back(near, far), i).otherwise(out)
    return out


def both_feeds(traffic: DataFrame, attributed: DataFrame) -> DataFrame:
    """Rows of both feeds under each other, ``_n`` 1 for traffic; attributed rows without a whole key belong to no ad."""
    whole = F.col(AD_KEY[0]).isNotNull()
    for k in AD_KEY[1:]:
        whole = whole & F.col(k).isNotNull()
    return traffic.withColumn("_n", F.lit(1)).unionByName(attributed.where(whole), allowMissingColumns=True)


def segment_sums(rows: DataFrame, keys: list[str], windows: list[DayWindow], sums: list[Column]) -> DataFrame:
    """A row per key with ``<segment>_<measure>`` columns; a row is added to the one segment it lies in, not to every window's sums."""
    return rows.groupBy(*keys).pivot("_segment", list(range(len(segments(windows))))).agg(*sums)


def window_base(w: DayWindow, windows: list[DayWindow]) -> dict[str, Column]:
    """Summed measures of a window from ``segment_sums``; attributed ones only where the ad has traffic in it."""
    own = [i for i, (near, far) in enumerate(segments(windows)) if w.near <= near and far <= w.far]

    def total(m: str) -> Column:
        parts = [F.col(f"{i}_{m}") for i in own]
        return parts[0] if len(parts) == 1 else F.when(F.coalesce(*parts).isNotNull(), sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0))))

    present = total("_n") > 0
    return {m: total(m) for m in TRAFFIC_MEASURES} | {m: F.when(present, total(m)) for m in ATTR_MEASURES}


def sem_features(universe: DataFrame, traffic: DataFrame, attributed: DataFrame, *, anchor: str,
                 windows: list[DayWindow], excluded=(), keep: list[str] | None = None,
                 prefix: str = "sem_") -> DataFrame:
    """Attributed ad signal for all windows: columns ``sem_<metric>_<window>``.

    Attributed measures count only where the ad has traffic in that window,
    exactly like the per-window left join they replace. Both feeds are summed by
    ad and segment of days, as narrow rows; only these are dealt by ad and laid
    side by side, so no wide row is shuffled for each part of the facts.
    """
    keep = keep or [*AD_KEY, "item_id", "seller_id"]
    feeds = [df.where(span_filter(day, anchor, windows, excluded))
             .select(*AD_KEY, *measures, day_segment(lambda near, far, day=day: window_filter(day, anchor, DayWindow("", far, near)), windows).alias("_segment"))
             for df, day, measures in ((traffic, "ds", TRAFFIC_MEASURES), (attributed, "ad_date", ATTR_MEASURES))]
    measures = ["_n", *TRAFFIC_MEASURES, *ATTR_MEASURES]
    by_segment = both_feeds(*feeds).where("_segment is not null").groupBy(*AD_KEY, "_segment").agg(*[F.sum(m).alias(m) for m in measures])
    wide = segment_sums(by_segment.repartition(*AD_KEY), AD_KEY, windows, [F.first(m).alias(m) for m in measures])
    j = universe.select(*keep).join(wide, AD_KEY, "left")
    spec = metric_spec(("brand", "seller"))
    cols: list[Column] = []
    for w in windows:
        cols += metric_columns(spec, window_base(w, windows), effective_days(anchor, w, excluded), prefix, f"_{w.name}")
    return j.select(*keep, *cols)


def multi_anchor_sums(traffic: DataFrame, *, anchors: list[str | dt.date], window: DayWindow,
                      excluded=(), measures: list[str] | None = None) -> DataFrame:
    """Window sums for several anchor days in one scan (ops B30, G2).

    Each row is exploded only into the anchors whose window holds its day,
    so the work grows with rows x matching anchors, never rows x anchors.
    """
    measures = measures or base_measures(None)
    anchors = [as_date(a) for a in anchors]
    lo = min(a - dt.timedelta(days=window.far) for a in anchors)
    hi = max(a - dt.timedelta(days=window.near) for a in anchors)
    arr = F.array(*[F.lit(a) for a in anchors])
    day = F.col("ds")
    fits = F.filter(arr, lambda a: (day >= F.date_sub(a, window.far)) & (day <= F.date_sub(a, window.near)))
    rows = traffic.where(day.between(F.lit(lo), F.lit(hi)))
    if excluded:
        rows = rows.where(~day.isin(*[F.lit(as_date(x)) for x in excluded]))
    return (rows.select(*AD_KEY, *measures, F.explode(fits).alias("snapshot_date"))
            .groupBy("snapshot_date", *AD_KEY).agg(*[F.sum(m).alias(m) for m in measures]))
