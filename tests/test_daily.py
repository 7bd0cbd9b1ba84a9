"""Daily sums by month: what is added, what is read, and windows of several anchors against plain sums."""

import datetime as dt
import random

from adperf.functions.windows import DayWindow, anchor_days, effective_days
from adperf.operators import daily as D
from adperf.operators.signals import ATTR_MEASURES, TRAFFIC_MEASURES
from adperf.session import scratch_path

DAY0 = dt.date(2001, 1, 1)
WINDOWS = [DayWindow("l3", 0, -6), DayWindow("w1", 13, 1), DayWindow("w2", 40, 14)]
EXCLUDED = ("2001-02-03", "2001-03-01")


def facts(spark, day, measures, seed, n=900):
    rng = random.Random(seed)
    rows = [(f"{rng.randint(1, 6)}_1", rng.choice([2, 4]), rng.randint(0, 1), DAY0 + dt.timedelta(days=rng.randint(0, 130)), *[float(rng.randint(0, 5)) for _ in measures]) for _ in range(n)]
    return rows, spark.createDataFrame(rows, f"ad_id string, source_id int, is_mobile int, {day} date, {', '.join(f'{m} double' for m in measures)}")


def test_months():
    assert D.months(dt.date(2000, 11, 30), dt.date(2001, 2, 1)) == ["2000-11", "2000-12", "2001-01", "2001-02"]


def test_only_missing_months_are_added(spark):
    rows, df = facts(spark, "ds", ["clicks"], 1)
    path = scratch_path(spark, "daily-test")
    assert D.stored_months(spark, path) == []
    assert D.add_days(df, path, "ds", ["clicks"], dt.date(2001, 2, 10), dt.date(2001, 3, 5)) == ["2001-02", "2001-03"]
    assert D.add_days(df, path, "ds", ["clicks"], dt.date(2001, 2, 10), dt.date(2001, 3, 5)) == []
    assert D.add_days(df, path, "ds", ["clicks"], dt.date(2001, 1, 20), dt.date(2001, 4, 1)) == ["2001-01", "2001-04"]
    assert D.add_days(df, path, "ds", ["clicks"], dt.date(2001, 1, 20), dt.date(2001, 4, 1), changed_since=dt.date(2001, 3, 20)) == ["2001-03", "2001-04"]
    assert D.stored_months(spark, path) == ["2001-01", "2001-02", "2001-03", "2001-04"]
    found = D.read_days(spark, path, dt.date(2001, 2, 10), dt.date(2001, 3, 5))
    want: dict = {}
    for ad, source, mobile, day, clicks in rows:
        if dt.date(2001, 2, 10) <= day <= dt.date(2001, 3, 5):
            want[ad, source, mobile, day] = want.get((ad, source, mobile, day), 0) + clicks
    assert {(r.ad_id, r.source_id, r.is_mobile, r.day): r.clicks for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1].split("]")[0]


def test_windows_of_several_anchors(spark):
    t_rows, t = facts(spark, "ds", TRAFFIC_MEASURES, 2)
    a_rows, a = facts(spark, "ad_date", ATTR_MEASURES, 3)
    anchors = anchor_days("2001-04-02", 5, 14)
    assert anchors[-1] == dt.date(2001, 2, 5) and len(anchors) == 5
    lo, hi = D.span(anchors, WINDOWS)
    days = []
    for df, day, measures in ((t, "ds", TRAFFIC_MEASURES), (a, "ad_date", ATTR_MEASURES)):
        path = scratch_path(spark, "daily-test")
        for anchor in anchors:
            D.add_days(df, path, day, measures, *D.span([anchor], WINDOWS))
        days.append(D.read_days(spark, path, lo, hi))
    got = {(r.snapshot_date, r.ad_id, r.source_id, r.is_mobile): r for r in D.anchored_features(*days, anchors=anchors, windows=WINDOWS, excluded=EXCLUDED).collect()}
    bad = {dt.date.fromisoformat(x) for x in EXCLUDED}

    def total(rows, measures, name, key, anchor, w):
        of = [r for r in rows if r[:3] == key and w.near <= (anchor - r[3]).days <= w.far and r[3] not in bad]
        return sum(r[4 + measures.index(name)] for r in of) if of else None

    seen = 0
    for anchor in anchors:
        for key in {r[:3] for r in t_rows}:
            if any(total(t_rows, TRAFFIC_MEASURES, "clicks", key, anchor, w) is not None for w in WINDOWS):
                r = got[(anchor, *key)]
                seen += 1
                for w in WINDOWS:
                    clicks, gmv = total(t_rows, TRAFFIC_MEASURES, "clicks", key, anchor, w), total(a_rows, ATTR_MEASURES, "gmv_brand", key, anchor, w)
                    assert r[f"sem_clicks_{w.name}"] == (None if clicks is None else clicks / effective_days(anchor, w, EXCLUDED))
                    assert r[f"sem_rpc_brand_{w.name}"] == (gmv / clicks if clicks and gmv is not None else None)
    assert seen == len(got)


def test_labels_get_their_common_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "ad_id int, sem_clicks_l3 int, sem_clicks_w1 int")
    assert D.renamed_labels(df).columns == ["ad_id", "sem_clicks_l", "sem_clicks_w1"]
