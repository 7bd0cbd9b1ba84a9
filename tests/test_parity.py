"""Optimised plan shapes against their naive forms on the test tables (sf0.001)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from adperf.functions.exprs import AD_KEY
from adperf.functions.windows import DayWindow
from adperf.operators import report as R
from adperf.operators import signals as S
from adperf.operators.features import multi_anchor_sums, sem_features
from adperf.plans.common import universe
from adperf.plans.params import ANCHOR, EXCLUDED, FEATURE_WINDOWS
from adperf.sources.fixtures import TestTables

SF = "/root/testdata/sf0.001"


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def _rows(df, key):
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}


def test_one_scan_windows_equal_per_window_signals(spark):
    T = TestTables(spark, SF)
    u = universe(T)
    keep = [*AD_KEY, "item_id", "seller_id"]
    wide = _rows(sem_features(u, T.traffic_daily, T.attributed_14d, anchor=ANCHOR, windows=FEATURE_WINDOWS,
                              excluded=EXCLUDED, keep=keep), keep)
    for w in FEATURE_WINDOWS:
        per = _rows(S.ad_signal_attr(u, T.traffic_daily, T.attributed_14d, anchor=ANCHOR, window=w, excluded=EXCLUDED), keep)
        assert per.keys() == wide.keys()
        for k, row in per.items():
            for m, v in row.items():
                if m in keep:
                    continue
                assert _close(v, wide[k][f"sem_{m}_{w.name}"]), (w.name, m, k)


def test_multi_anchor_equals_per_anchor(spark):
    T = TestTables(spark, SF)
    w = DayWindow("w", 90, 1)
    anchors = ["2001-06-30", "2001-06-16"]
    both = _rows(multi_anchor_sums(T.traffic_daily, anchors=anchors, window=w, excluded=EXCLUDED,
                                   measures=["clicks", "gmv"]), ["snapshot_date", *AD_KEY])
    n = 0
    for a in anchors:
        one = S.window_sums(T.traffic_daily, AD_KEY, ["clicks", "gmv"], "ds", a, w, EXCLUDED).collect()
        for r in one:
            got = both[(dt.date.fromisoformat(a), r.ad_id, r.source_id, r.is_mobile)]
            assert _close(got["clicks"], r.clicks) and _close(got["gmv"], r.gmv)
            n += 1
    assert n == len(both)


def test_split_or_join_equals_literal_or_join(spark):
    """Sellers null or not, source 4 or not, rows that differ in is_pla and is_target_all only, and rows without a partner."""
    measures = [*R.SPEND, *R.SHARES]
    spend = [("i1", "s1", "d", 2, 0, 1, 0), ("i2", None, "d", 4, 0, 1, 1), ("i3", "s3", "d", 4, 1, 1, 1), ("i5", None, "d", 2, 0, 1, 0),
             ("i6", "s1", "d", 4, 0, 0, 0), ("i6", "s1", "d", 4, 0, 1, 0), ("i6", "s1", "d", 4, 0, 1, 1), ("i7", "s1", "d", 2, 0, 0, 0)]
    revenue = [("i1", "s1", "d", 2, 0, 1, 0), ("i1", "s9", "d", 2, 0, 1, 0), ("i2", "a", "d", 4, 0, 1, 1), ("i2", "b", "d", 4, 0, 1, 1),
               ("i5", "0", "d", 2, 0, 1, 0), ("i6", "s1", "d", 4, 0, 1, 0), ("i6", None, "d", 4, 0, 1, 0), ("i7", "s1", "d", 2, 0, 1, 0)]
    key = "item_id string, seller_id string, day string, source_id int, is_mobile int, is_pla int, is_target_all int"
    sdf = spark.createDataFrame([(*r, *[100.0 + 10 * i + j for j in range(len(measures))]) for i, r in enumerate(spend)],
                                key + "".join(f", {m} double" for m in measures))
    rdf = spark.createDataFrame([(*r, *[1.0 + i + j / 64 for j in range(len(R.REVENUE))]) for i, r in enumerate(revenue)],
                                key + "".join(f", {m} double" for m in R.REVENUE))
    s, r = sdf.collect(), rdf.collect()
    same = lambda a, b: all(a[k] == b[k] for k in R.ITEM_KEY)
    want, met = [], set()

    def row(a, b):
        n = sum(same(b, x) for x in r) if a and b and a.source_id == 4 else 1
        first = a or b
        seller = (a.seller_id if a else None) or (b.seller_id if b else None) or "0"
        return (*[first[k] for k in R.ITEM_KEY], seller, *[a[m] / n if a else 0.0 for m in R.SPEND], *[a[m] if a else 0.0 for m in R.SHARES],
                *[b[m] if b else 0.0 for m in R.REVENUE])

    for a in s:
        found = [b for b in r if same(a, b) and ((a.seller_id or "0") == (b.seller_id or "0") or a.source_id == 4)]
        met.update(found)
        want += [row(a, b) for b in found] or [row(a, None)]
    want += [row(None, b) for b in r if b not in met]
    got = R.first_structure_report(sdf, rdf).select(*R.ITEM_KEY, "seller_id", *R.SPEND, *R.SHARES, *R.REVENUE)
    assert sorted(map(tuple, got.collect())) == sorted(want)
