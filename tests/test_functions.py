import datetime as dt

from pyspark.sql import functions as F

from adperf.functions.exprs import ad_item, canonical_id, clip_zero, is_dst, nested_value, not_sentinel, url_param
from adperf.functions.metrics import metric_pack
from adperf.functions.names import FeatureName, remap_windows
from adperf.functions.windows import DayWindow, effective_days, window_filter


def test_effective_days_and_full_exclusion():
    w = DayWindow("w", 6, 0)
    assert effective_days("2001-06-30", w, ["2001-06-30", "2001-01-01"]) == 6
    tiny = DayWindow("t", 1, 1)
    assert effective_days("2001-06-30", tiny, ["2001-06-29"]) == 0


def test_window_filter_bounds_and_exclusion(spark):
    days = [dt.date(2001, 6, d) for d in range(20, 31)]
    df = spark.createDataFrame([(d,) for d in days], "ds date")
    got = {r.ds for r in df.where(window_filter("ds", "2001-06-30", DayWindow("w", 6, 1), ["2001-06-27"])).collect()}
    assert got == {dt.date(2001, 6, d) for d in (24, 25, 26, 28, 29)}


def test_metric_pack_zero_divisors_are_null(spark):
    row = dict(impressions=0.0, clicks=0.0, adspend=1.0, qty=1.0, orders=0.0, gmv=5.0, cost=1.0, estimated_cp=0.0)
    df = spark.createDataFrame([row])
    out = metric_pack(df, 0, targets=None).collect()[0].asDict()
    assert out["ctr"] is None and out["cpc"] is None and out["ordersize"] is None and out["clicks"] is None
    out2 = metric_pack(df, 2, targets=None).collect()[0].asDict()
    assert out2["gmv"] == 2.5 and out2["margin"] == 2.0


def test_key_parsing_and_sentinels(spark):
    df = spark.createDataFrame([("123_4",), ("",), (None,), ("\\N",)], "a string")
    rows = df.select(ad_item("a").alias("i"), not_sentinel("a").alias("ok")).collect()
    assert [r.i for r in rows] == ["123", "", None, "\\N"]
    assert [r.ok for r in rows] == [True, False, False, False]


def test_nested_value_missing_parts(spark):
    df = spark.createDataFrame([([{"catlgItm": {"sellerId": "7"}}],), ([],), (None,), ([{"x": {"sellerId": "1"}}],)],
                               "l array<map<string,map<string,string>>>")
    got = [r.s for r in df.select(nested_value("l", "catlgItm", "sellerId").alias("s")).collect()]
    assert got == ["7", None, None, None]


def test_url_params_edge_cases(spark):
    urls = ["http://a.b/p?wl12=9_0&x=1", "not a url ::", "http://a.b/p?wl12=1&wl12=2", "http://a.b/p?WL12=5"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r.v for r in df.select(url_param("u", "wl12").alias("v")).collect()]
    assert got[0] == "9_0" and got[1] is None and got[2] == "1" and got[3] is None


def test_canonical_id_and_clip(spark):
    df = spark.createDataFrame([("00123.0", -1.5), ("abc", None), ("7", 2.0)], "i string, p double")
    rows = df.select(canonical_id("i").alias("c"), clip_zero("p").alias("k")).collect()
    assert [r.c for r in rows] == ["123", None, "7"]
    assert [r.k for r in rows] == [0.0, None, 2.0]


def test_feature_names_and_remap(spark):
    assert FeatureName.parse("sem_convrt_seller_w1") == FeatureName("sem", "convrt_seller", "w1")
    df = spark.createDataFrame([(1, 1.0, 2.0, 3.0)], "k int, sem_clicks_w1 double, sem_clicks_w2 double, sem_clicks_v9 double")
    assert remap_windows(df, ["k"]).columns == ["k", "sem_clicks_m2", "sem_clicks_m1"]


def test_is_dst():
    assert is_dst("2001-06-30") and not is_dst("2024-01-05")
