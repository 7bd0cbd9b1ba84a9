import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from adperf.operators import attribution as A
from adperf.operators import publish as P
from adperf.session import scratch_path
from adperf.sources.files import create_partitioned
from adperf.sources.scans import newest_partition, newest_snapshot

D = dt.date


def _params(spark):
    return spark.createDataFrame([(1, "^2{9}[0-9]+$", 10, 10)], "customer_id int, id_regex string, channel_pos int, adid_length int")


def test_tracking_id_branches(spark):
    rows = [(1, D(2001, 6, 30), D(2001, 6, 29), "22222222227123_1_1_1", "http://s/ip?wl12=123_0&selectedsellerid=1"),
            (2, D(2001, 6, 30), D(2001, 6, 29), "22222222237123_1_1", "http://s/ip?wl12=123_0&selectedsellerid=2"),
            (3, D(2001, 6, 30), D(2001, 6, 29), "2222222222280123", "http://s/ip?wl12=123_0&selectedsellerid=0"),
            (4, D(2001, 6, 30), D(2001, 6, 29), "garbage", "http://s/ip?wl12=123_0"),
            (5, D(2001, 6, 30), D(2001, 6, 29), "garbage", "http://s/ip?wl12=123_0"),
            (6, D(2001, 6, 30), D(2001, 6, 29), None, "http://s/ip?wl12=123_0")]
    v = spark.createDataFrame([(*r, "2222222222280456" if r[0] >= 5 else None, r[0] * 60) for r in rows],
                              "order_no long, order_date date, visit_day date, tracking_id string, page_url string, "
                              "reflector_id string, visit_epoch long")
    got = {r.order_no: r for r in A.parse_visits(v, _params(spark)).collect()}
    assert (got[1].adid, got[1].channel_id, got[1].item_ad, got[1].seller_ad, got[1].f_nas) == ("123_1_1_1", "27", "123", "1", "nas")
    assert (got[2].channel_id, got[2].item_ad, got[2].seller_ad, got[2].f_nas) == ("37", "123", "2", "nas")
    assert (got[3].adid, got[3].channel_id, got[3].f_nas) == ("80123", "22", "oas")
    assert got[4].adid is None and got[4].channel_id is None
    assert (got[5].adid, got[5].channel_id, got[5].f_nas, got[5].visit_epoch) == ("80456", "22", "oas", 300)
    assert 6 not in got  # no tracking id, no touch


def test_channel_decode_unknown(spark):
    df = spark.createDataFrame([("27",), ("99",), (None,), ("x",)], "channel_id string")
    got = [(r.is_pla, r.source_id, r.is_mobile) for r in A.decode_channel(df).orderBy(F.col("channel_id").asc_nulls_last()).collect()]
    assert got[0] == (1, 2, 0) and got[1] == (0, 6, 0) and got[2] == (0, 6, 0) and got[3] == (0, 6, 0)


def test_lookback_13_kept_14_dropped(spark):
    df = spark.createDataFrame([(D(2001, 6, 30), D(2001, 6, 17)), (D(2001, 6, 30), D(2001, 6, 16))], "order_date date, ad_date date")
    assert A.lookback(df).collect()[0].ad_date == D(2001, 6, 17)


def test_two_touches_claim_one_line(spark):
    cols = {f"same_{f}": 0 for f in A.FLAGS}
    base = dict(order_no=1, order_line_nbr=1, **cols)
    r1, r2 = dict(base, same_item=1), dict(base, same_item=1, same_brand=1)
    df = spark.createDataFrame([r1, r2])
    got = A.claimant_counts(df).collect()
    assert all(r.num_claimants_item == 2 for r in got)
    assert sorted(r.num_claimants_brand for r in got) == [0, 1]


TOUCH = "order_no long, t int, item_ad string, ad_brand string, event_ad int, seller_ad string"
LINE = "order_no long, order_line_nbr int, item_purchase string, purchase_brand string, event_purchase int, seller_purchase string"


def test_claims_equal_the_window_over_all_pairs(spark):
    rnd = random.Random(5)
    pick = lambda n: rnd.choice([None, "", *map(str, range(n))])
    side = lambda: (pick(9), pick(5), rnd.choice([None, 1, 2, 3]), pick(3))
    touches = [(rnd.randrange(6), t, *side()) for t in range(60)]
    touches += touches[:5]  # repeated rows
    lines = [(o, n, *side()) for o in range(6) for n in (None, 1, 2, 3, 4)]
    touches, lines = spark.createDataFrame(touches, TOUCH), spark.createDataFrame(lines, LINE)
    plain = A.claimant_counts(A.relation_flags(A.touch_lines(touches, lines)))
    got = A.claims(touches, lines).select(*plain.columns)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(got) == rows(plain) and got.count() > 50
    assert A.claims(touches.limit(0), lines).count() == 0 and A.claims(touches, lines.limit(0)).count() == 0


def test_hot_order_makes_only_related_pairs(spark):
    n = 200_000
    touches = spark.range(n).selectExpr("1L as order_no", "cast(id as int) as t", "concat('a', id) as item_ad", "concat('b', id) as ad_brand",
                                        "cast(null as int) as event_ad", "concat('s', id % 50000) as seller_ad")
    lines = spark.range(n).selectExpr("1L as order_no", "cast(id as int) as order_line_nbr", "concat('a', id * 1000) as item_purchase",
                                      "concat('c', id) as purchase_brand", "7 as event_purchase", "concat('x', id) as seller_purchase")
    got = A.claims(touches, lines)  # 40 billion pairs in all
    assert got.count() == 200 and got.agg(F.sum("num_claimants_item")).first()[0] == 200


def test_orders_of_few_rows_meet_as_a_whole(spark):
    """Whichever orders are crowded, the rows are the same; the others' rows are not dealt by relation, their pairs not again by line."""
    rnd = random.Random(5)
    side = lambda: [rnd.choice([None, "a", "b", "c"]), rnd.choice([None, "x", "y"]), rnd.choice([None, 1, 2]), rnd.choice([None, "0", "s"])]
    touches = spark.createDataFrame([(rnd.choice([None, *range(7)]), t, *side()) for t in range(80)], TOUCH)
    lines = spark.createDataFrame([(o, n, *side()) for o in (None, *range(7)) for n in (None, 1, 2, 3)], LINE)
    want = A.claims(touches, lines)
    rows = lambda df: sorted(map(str, df.select(*want.columns).collect()))
    assert [r.order_no for r in A.crowded_orders(spark.createDataFrame([(4,), (4,), (4,), (5,)], "order_no int"), most=2).collect()] == [4]
    for crowded in ([], [1, 4], [None, *range(7)]):
        got = A.claims_by_order(touches, lines, spark.createDataFrame([(o,) for o in crowded], "order_no int"))
        assert rows(got) == rows(want)
    wide = lambda df, name: df.hint("merge").withColumn(name, F.lit("w" * 30))
    plan = A.claims_by_order(wide(touches, "t"), wide(lines, "l"), spark.range(0).selectExpr("cast(id as int) as order_no"))
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "relation" not in final and "hashpartitioning(order_no" in final and "order_line_nbr" not in "".join(x.split(")")[0] for x in final.split("hashpartitioning(")[1:])


def test_claims_shuffle_each_side_once_and_the_pairs_once(spark):
    touches = spark.createDataFrame([(1, 1, "a", "b", 1, "s"), (1, 2, "a", None, None, "s")], TOUCH)
    lines = spark.createDataFrame([(1, 1, "a", "b", None, "s"), (1, 2, "x", "b", 1, "t")], LINE)
    got = A.claims(touches, lines)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") + plan.count("SortAggregate") == 0 and plan.count("Join") == 1
    counts = sorted((r.t, r.order_line_nbr, r.num_claimants_item, r.num_claimants_brand, r.num_claimants_coop, r.num_claimants_seller) for r in got.collect())
    assert counts == [(1, 1, 2, 1, 0, 2), (1, 2, 0, 1, 1, 0), (2, 1, 2, 0, 0, 2)]


def _bids(spark):
    return spark.createDataFrame(
        [("a", 2, 0, "D1", "S", 10.0, 1.0, "base"), ("b", 2, 0, "D1", "S", 10.0, 2.0, "base"),
         ("c", 2, 0, "D2", "S", 10.0, 3.0, "base"), ("d", 2, 0, "D1", "S", 10.0, 4.0, "base")],
        "ad_id string, source_id int, is_mobile int, division string, super_dept string, clicks_l2wk double, "
        "adjusted_rpc double, adj_reason string")


def test_gated_override_rules(spark):
    preds = spark.createDataFrame([("a", 0, "D1", 0.1, 20.0), ("b", 0, "D1", 0.0, 20.0), ("c", 0, "D2", 0.1, 20.0),
                                   ("d", 0, "D1", None, 20.0)],
                                  "ad_id string, is_mobile int, division string, pred_convrt double, pred_ordersize double")
    groups = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("d", "0")], "adid string, grp string")
    got = {r.ad_id: r for r in P.gated_override(_bids(spark), preds, groups, ["D1"]).collect()}
    assert got["a"].adjusted_rpc == 2.0 and got["a"].adj_reason.startswith('{"objective":"Experiment"')
    assert got["b"].adjusted_rpc == 2.0 and got["b"].adj_reason == "base"  # rpc 0: not overridden
    assert got["c"].adjusted_rpc == 3.0  # division not in list
    assert got["d"].adjusted_rpc == 4.0  # not in experiment group
    assert P.modified_count(P.gated_override(_bids(spark), preds, groups, ["D1"])).collect()[0].modified == 1
    assert P.gated_override(_bids(spark), preds).count() == 4


def test_publish_touches_only_present_partitions(spark):
    path = scratch_path(spark, "test-publish")
    df = _bids(spark).withColumn("ds", F.lit("d1")).unionByName(_bids(spark).withColumn("ds", F.lit("d2")))
    P.publish_dynamic(df, path, ["ds"])
    new = _bids(spark).withColumn("adjusted_rpc", F.lit(9.0)).withColumn("ds", F.lit("d2"))
    got = P.publish_dynamic(new, path, ["ds"], expected_rows=_bids(spark))
    assert got["rows"] == 4
    back = spark.read.parquet(path)
    assert back.where("ds = 'd1'").agg(F.sum("adjusted_rpc")).collect()[0][0] == 10.0
    assert back.where("ds = 'd2'").agg(F.sum("adjusted_rpc")).collect()[0][0] == 36.0


def test_publish_of_a_wrong_row_count_changes_nothing(spark):
    path = scratch_path(spark, "test-publish-count")
    P.publish_dynamic(_bids(spark).withColumn("ds", F.lit("d1")), path, ["ds"])
    fewer = _bids(spark).limit(2).withColumn("ds", F.lit("d1"))
    with pytest.raises(ValueError, match="2 rows to publish, expected 4"):
        P.publish_dynamic(fewer, path, ["ds"], expected_rows=_bids(spark))
    assert spark.read.parquet(path).count() == 4


def test_publish_may_read_the_partition_it_overwrites(spark):
    path = scratch_path(spark, "test-publish-self")
    P.publish_dynamic(_bids(spark).withColumn("ds", F.lit("d1")), path, ["ds"])
    doubled = spark.read.parquet(path).withColumn("adjusted_rpc", F.col("adjusted_rpc") * 2)
    P.publish_dynamic(doubled, path, ["ds"])
    assert spark.read.parquet(path).agg(F.sum("adjusted_rpc")).first()[0] == 20.0


def _catalog_bids(spark, days=("d1", "d2")):
    path = scratch_path(spark, "test-catalog")
    name = f"bids_{path[-12:]}"
    schema = "ad_id string, adjusted_rpc double, ds string, tier string"
    create_partitioned(spark, name, schema, ["ds", "tier"], path)
    rows = _bids(spark).select("ad_id", "adjusted_rpc", F.explode(F.array(*map(F.lit, days))).alias("ds"), F.lit("a:b c+'d").alias("tier"))
    rows.write.insertInto(name)
    return name


def test_catalog_publish_swaps_named_partitions_only(spark):
    name = _catalog_bids(spark)
    new = spark.table(name).where("ds = 'd2'").withColumn("adjusted_rpc", F.col("adjusted_rpc") * 2)  # reads what it replaces
    extra = new.limit(1).withColumn("tier", F.lit("new"))
    got = P.publish_table(new.unionByName(extra), name, {"ds": "d2"}, ["tier"])
    assert got["rows"] == 5 and len(got["replaced"]) == 1
    sums = {(r.ds, r.tier): r.s for r in spark.table(name).groupBy("ds", "tier").agg(F.sum("adjusted_rpc").alias("s")).collect()}
    assert sums[("d1", "a:b c+'d")] == 10.0 and sums[("d2", "a:b c+'d")] == 20.0 and len(sums) == 3
    assert spark.read.parquet(got["replaced"][0]).count() == 4  # a reader that had begun still has its files


def test_catalog_publish_refuses_wrong_counts_and_missing_partitions(spark):
    name = _catalog_bids(spark)
    rows = spark.table(name).where("ds = 'd2'")
    with pytest.raises(ValueError, match="2 rows to publish"):
        P.publish_table(rows.limit(2), name, {"ds": "d2"}, ["tier"], expected_rows=rows)
    with pytest.raises(ValueError, match="4 of them without a partition"):
        P.publish_table(rows.withColumn("tier", F.lit(None).cast("string")), name, {"ds": "d2"}, ["tier"])
    assert P.publish_table(rows.limit(0), name, {"ds": "d2"}, ["tier"]) == {"rows": 0, "replaced": []}
    assert spark.table(name).agg(F.sum("adjusted_rpc")).first()[0] == 20.0


def test_newest_partition_is_listed_and_read_alone(spark):
    path = scratch_path(spark, "test-newest")
    name = f"snap_{path[-12:]}"
    create_partitioned(spark, name, "v int, n int", ["n"], path)
    assert newest_partition(spark, name, "n") is None and newest_snapshot(spark, name, "n").count() == 0
    spark.createDataFrame([(1, 9), (2, 10), (3, None)], "v int, n int").write.insertInto(name)
    newest = newest_snapshot(spark, name, "n")
    assert newest_partition(spark, name, "n") == 10 and [r.v for r in newest.collect()] == [2]
    assert "InMemoryFileIndex(1 paths)" in newest._jdf.queryExecution().executedPlan().toString()


def test_a_tracking_id_is_matched_once_a_row(spark):
    visits = spark.createDataFrame([], "order_no long, order_date date, visit_day date, tracking_id string, page_url string, reflector_id string, visit_epoch long").cache()
    refs = spark.createDataFrame([], "order_no long, order_date date, created_on date, reflector_id string").cache()
    xref = spark.createDataFrame([], "legacy_id long, item_id string").cache()
    for df in (A.decoded_visits(visits, _params(spark)), A.decoded_referrers(refs, _params(spark), xref)):
        plan = df._jdf.queryExecution().optimizedPlan().toString().upper()
        assert plan.count("RLIKE") == 3, plan  # 19 and 14 when every column repeated the patterns
