import datetime as dt
import random

from pyspark.sql import functions as F

from adperf.functions.windows import DayWindow
from adperf.operators import clicks as K
from adperf.operators import evaluate as V
from adperf.operators import ordering as O
from adperf.operators import signals as S

D = dt.date


def _traffic(spark, rows):
    return spark.createDataFrame(rows, "ad_id string, source_id int, is_mobile int, seller_id string, ds date, "
                                       "impressions double, clicks double, adspend double, qty double, orders double, "
                                       "gmv double, cost double, estimated_cp double")


def test_attributed_sums_do_not_inflate_with_duplicate_xref(spark):
    t = _traffic(spark, [("1_0", 2, 0, "0", D(2001, 6, 28), 10.0, 2.0, 1.0, 1.0, 1.0, 10.0, 1.0, 1.0)] * 3)
    a = spark.createDataFrame([("1_0", 2, 0, D(2001, 6, 28), 1.0, 1.0, 4.0, 2.0)],
                              "ad_id string, source_id int, is_mobile int, ad_date date, orders_brand double, "
                              "orders_seller double, gmv_brand double, gmv_seller double")
    s = S.attributed_sums(t, a, anchor="2001-06-30", window=DayWindow("w", 7, 1)).collect()[0]
    assert s.clicks == 6.0 and s.gmv_brand == 4.0


def _daily(spark, clicks):
    rows = [("a", 2, 0, D(2001, 1, 1) + dt.timedelta(days=i), "1", "0", c, *[0.0] * 9) for i, c in enumerate(clicks)]
    return spark.createDataFrame(rows, "ad_id string, source_id int, is_mobile int, ds date, item_id string, "
                                       "seller_id string, clicks double, impressions double, adspend double, qty double, "
                                       "cost double, estimated_cp double, orders_brand double, orders_seller double, "
                                       "gmv_brand double, gmv_seller double")


def test_first_n_cutoff_inclusive_and_absent(spark):
    df = _daily(spark, [10.0, 20.0, 10.0])
    assert K.first_n_cutoff(df, 30).collect()[0].cutoff_ds == D(2001, 1, 2)
    assert K.first_n_cutoff(df, 41).count() == 0


def test_click_bucket_matches_brute_force(spark):
    random.seed(7)
    clicks = [float(random.randint(0, 30)) for _ in range(40)]
    cuts = [0, 50, 100, 200]
    got = {r.bucket: (r.clicks * r.total_days, r.total_days) for r in K.click_bucket(_daily(spark, clicks), cuts).collect()}
    days = [D(2001, 1, 1) + dt.timedelta(days=i) for i in range(len(clicks))]

    def cutoff(t):
        cum, best = 0.0, None
        for d, c in sorted(zip(days, clicks), reverse=True):
            cum += c
            if cum >= t:
                best = d if best is None else max(best, d)
        return best

    for j in range(len(cuts) - 1):
        hi, lo = cutoff(cuts[j]), cutoff(cuts[j + 1])
        if hi is None or lo is None:
            assert f"c{j}" not in got
            continue
        want = sum(c for d, c in zip(days, clicks) if lo <= d <= hi)
        total, n = got[f"c{j}"]
        assert n == (hi - lo).days + 1
        assert abs(total - want) < 1e-9


def test_dedup_first_keeps_earliest(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, o int, v string")
    got = {r.k: (r.o, r.v) for r in O.dedup_first(df, ["k"], ["o"]).collect()}
    assert got == {"a": (1, "y"), "b": (2, "z")}


def test_weighted_errors_skip_incomplete_rows(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1.0), (3.0, 1.0, 3.0), (None, 1.0, 5.0), (2.0, None, 5.0)], "y double, p double, w double")
    r = df.agg(*V.weighted_errors(df, "y", "p", "w")).collect()[0]
    assert r.n == 2
    assert abs(r.wmae - (1.0 * 1 + 2.0 * 3) / 4) < 1e-12
    assert abs(r.wrmse - ((1.0 * 1 + 4.0 * 3) / 4) ** 0.5) < 1e-12


def test_hash_folds_are_stable_and_balanced(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    a = V.fold_assign(df, ["k"], 5).groupBy("fold").count().collect()
    assert len(a) == 5 and all(300 < r["count"] < 500 for r in a)
    b = V.fold_assign(df, ["k"], 5).collect()
    assert b == V.fold_assign(df, ["k"], 5).collect()


def test_topn_is_the_head_of_the_whole_order(spark):
    """Below, at and above the number of rows, with nulls and ties of the first column, in one range and in several."""
    rng = random.Random(11)
    rows = [(rng.choice([None, *range(40)]), f"k{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "c int, k string").repartition(5)
    whole = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    for few_ranges in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", few_ranges)
        try:
            for n in (0, 1, 700, 1501, 2999, 3000, 4000):
                top = O.topn(df, n, [F.col("c").desc_nulls_last(), F.col("k").asc()])
                assert list(map(tuple, top.collect())) == whole[:n], n
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert O.topn(df.limit(0), 5, [F.col("k").asc()]).count() == 0


def test_topn_queries_take_the_sources_n(spark):
    """sf0.01 has more than 1,000 ads and fewer than 500,000: all of them are returned, the best first."""
    import __spark_entry__ as E
    from adperf.plans import q_clicks
    from adperf.plans.common import tables, universe

    sf = "/root/testdata/sf0.01"
    n = universe(tables(spark, sf)).count()
    assert 1000 < n < q_clicks.TOP_N == 500_000
    clicks = [r.clicks for r in E.queries()["topn_clicks"](spark, sf).collect()]
    assert len(clicks) == n and clicks == sorted(clicks, key=lambda c: (c is None, -(c or 0)))
    assert E.queries()["topn_complete"](spark, sf).count() == n
    assert "limit 500000" in E.oracle_sql()["topn_clicks"] and "limit 500000" in E.oracle_sql()["topn_complete"]


def test_boosted_models_learn_from_every_signal_and_window_but_the_label():
    from adperf.plans import q_model
    from adperf.plans.params import FEATURE_WINDOWS, SITE_WINDOWS

    f = q_model.GBT_FEATURES
    assert len(f) == len(set(f)) and not any(x.endswith("_l") for x in f)
    assert all(f"sem_{m}_{w.name}" in f for m in ("clicks", "gmv_seller", "roas_brand") for w in FEATURE_WINDOWS if w.name != "l")
    assert all(x in f for w in SITE_WINDOWS for x in (f"site_convrt_{w.name}", f"bc_bounce_rate_{w.name}"))
    assert {"is_mobile", "uber_curr_item_price_w1", "uber_weight_price_cart_w1_brand", "title_svd_31", "desc_svd_63"} <= set(f)


def test_report_brings_its_wide_rows_together_once(spark):
    from adperf.operators import report as R

    days = [("i1", "0"), ("i1", None), ("i1", "2"), ("i2", "1"), (None, "1"), (None, "2")]
    rows = [(item, seller, f"{item}_{seller}", 4, 0, 1, 1, 0, dt.date(2001, 1, 1)) for item, seller in days for _ in range(2)]
    feed = spark.createDataFrame(rows, "item_id string, seller_id string, ad_id string, source_id int, is_mobile int, is_pla int, structure_version int, "
                                       "is_target_all int, ad_date date").withColumns({m: F.lit(1.0) for m in R.REVENUE})
    out = R.even_split(R.attributed_rollup(feed.repartition("item_id")))
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {(r.item_id, r.seller_id): (r.num_sellers, r.gmv_item) for r in out.collect()} == {
        (i, s): ({"i1": 3, "i2": 1}.get(i), 2.0) for i, s in days}
    spend = out.select(*R.KEY, *[F.lit(3.0).alias(m) for m in [*R.SPEND, *R.SHARES]])
    brands = spark.createDataFrame([("i1", "b1"), ("i3", "b3")], "item_id string, brand string")
    revenue = R.attributed_rollup(feed)
    late = R.branded(R.first_structure_report(spend, revenue), brands)
    early = R.first_structure_report(spend, revenue, brands)
    assert sorted(map(str, early.select(*R.REPORT).collect())) == sorted(map(str, late.select(*R.REPORT).collect()))
