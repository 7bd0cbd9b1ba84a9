"""Windows as unions of day segments, and rows that are summed into segments only."""

import datetime as dt
import random

from adperf.functions.windows import DayWindow, effective_days, segments
from adperf.operators import features as J
from adperf.operators import merge as G
from adperf.operators.signals import ATTR_MEASURES, TRAFFIC_MEASURES

ANCHOR = dt.date(2001, 6, 30)
WINDOWS = [DayWindow("l", 0, -5), DayWindow("w1", 10, 1), DayWindow("w2", 15, 6), DayWindow("v9", 60, 41)]


def test_segments_cut_overlapping_windows_and_leave_gaps_out():
    assert segments(WINDOWS) == [(-5, 0), (1, 5), (6, 10), (11, 15), (41, 60)]
    assert segments([DayWindow("a", 3, 3)]) == [(3, 3)]


def _feed(spark, day, measures, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([2, 4]), 0, ANCHOR - dt.timedelta(days=rng.randint(-8, 70)),
             *[rng.choice([None, float(rng.randint(0, 5))]) for _ in measures]) for _ in range(300)]
    return rows, spark.createDataFrame(rows, f"ad_id string, source_id int, is_mobile int, {day} date, {', '.join(f'{m} double' for m in measures)}")


def test_overlapping_windows_and_null_keys(spark):
    traffic, t = _feed(spark, "ds", TRAFFIC_MEASURES, 1)
    traffic = [r for r in traffic if r[:2] != ("c", 4)]  # an ad with attributed orders and no traffic
    t = t.where("not (ad_id <=> 'c' and source_id = 4)")
    attributed, a = _feed(spark, "ad_date", ATTR_MEASURES, 2)
    ads = [("a", 2, 0), ("a", 4, 0), ("b", 2, 0), ("c", 4, 0), (None, 2, 0), ("d", 2, 0)]
    universe = spark.createDataFrame([(*x, "i", "s") for x in ads], "ad_id string, source_id int, is_mobile int, item_id string, seller_id string")
    got = {(r.ad_id, r.source_id): r for r in J.sem_features(universe, t, a, anchor=ANCHOR, windows=WINDOWS, excluded=("2001-06-24",)).collect()}
    assert len(got) == len(ads)

    def total(rows, names, name, ad, w):
        of = [r[4 + names.index(name)] for r in rows if None not in r[:3] and r[:3] == ad and w.near <= (ANCHOR - r[3]).days <= w.far and r[3] != dt.date(2001, 6, 24)]
        return bool(of), sum(x for x in of if x is not None) if any(x is not None for x in of) else None

    for ad in ads:
        for w in WINDOWS:
            seen, clicks = total(traffic, TRAFFIC_MEASURES, "clicks", ad, w)
            gmv = total(attributed, ATTR_MEASURES, "gmv_brand", ad, w)[1] if seen else None
            r, days = got[ad[:2]], effective_days(ANCHOR, w, ("2001-06-24",))
            assert r[f"sem_clicks_{w.name}"] == (None if clicks is None else clicks / days)
            assert r[f"sem_gmv_brand_{w.name}"] == (None if gmv is None else gmv / days)


def test_facts_are_not_shuffled_as_rows_of_all_windows(spark):
    """Before, each part of the facts gave a row with a sum for every window and measure."""
    _, t = _feed(spark, "ds", TRAFFIC_MEASURES, 1)
    _, a = _feed(spark, "ad_date", ATTR_MEASURES, 2)
    universe = t.select("ad_id", "source_id", "is_mobile").distinct().selectExpr("*", "ad_id as item_id", "'s' as seller_id")
    plan = J.sem_features(universe, t, a, anchor=ANCHOR, windows=WINDOWS)._jdf.queryExecution().executedPlan()
    seen, todo, widths = set(), [plan], []
    while todo:
        p = todo.pop()
        todo += [p.children().apply(i) for i in range(p.children().size())] + ([p.inputPlan()] if p.nodeName() == "AdaptiveSparkPlan" else [])
        if p.nodeName() == "Exchange":
            widths.append(p.output().size())
    assert widths and max(widths) <= len([*TRAFFIC_MEASURES, *ATTR_MEASURES]) + 5


def test_merge_keeps_rows_columns_and_their_order(spark):
    header = spark.createDataFrame([("a", 2, 0, "i", "s", "B"), ("b", 2, 0, "i", "s", None), ("c", 2, 0, None, "s", "B")],
                                   "ad_id string, source_id int, is_mobile int, item_id string, seller_id string, brand string")
    sem = spark.createDataFrame([("a", 2, 0, "i", "s", 1.0), ("a", 2, 0, "i", "s", 2.0), ("c", 2, 0, None, "s", 3.0)],
                                "ad_id string, source_id int, is_mobile int, item_id string, seller_id string, sem_clicks_l double")
    offer = spark.createDataFrame([("i", "s", 7), (None, "s", 8)], "item_id string, seller_id string, visits int")
    out = G.feature_merge(header, sem, {("bc", "w1"): offer})
    assert out.columns == ["ad_id", "source_id", "is_mobile", "item_id", "seller_id", "brand", "sem_clicks_l", "bc_visits_w1"]
    assert sorted((r.ad_id, r.sem_clicks_l, r.bc_visits_w1) for r in out.collect() if r.ad_id == "a") == [("a", 1.0, 7), ("a", 2.0, 7)]
    assert {(r.ad_id, r.sem_clicks_l, r.bc_visits_w1) for r in out.collect() if r.ad_id != "a"} == {("b", None, 7), ("c", None, None)}
