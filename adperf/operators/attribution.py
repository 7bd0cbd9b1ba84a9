"""Order attribution: touches before an order -> order lines -> relation flags -> claimants (ops B21-B27, C13-C20, D14, D15, J1).

Shape of the plan: both touch feeds are parsed with built-in string functions
(no UDF), channel codes are decoded by one broadcast join to a fixed channel
dimension, and the feeds are merged with a full outer join on the touch key.
Brands and promo events are attached to touches and to lines before the two
meet. Only related pairs of touch and line are ever made, by one join on
(order, relation, value), so an order with many touches and many lines is no
product; claimants are counted over a line's related pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adperf.functions.exprs import brand_norm, url_param
from adperf.operators.ordering import dedup_first

# Tracking-id grammars (new ad structure, 4-part and 3-part ids).
PLA_ID = r"^2{7}22[0-9]{2}[0-9]+_[0-9]+_[0-9]+_[0-9]+$"
LIA_ID = r"^2{7}22[0-9]{2}[0-9]+_[0-9]+_[0-9]+$"

# Channel code lists -> ad type, traffic source, mobile flag.
AD_TYPE_CHANNELS = {1: [81, 82, 27, 28, 22, 23], 2: [54, 55, 64, 65], 4: [37, 38, 77, 78]}
SOURCE_CHANNELS = {2: [20, 21, 27, 28, 37, 38, 77, 78], 4: [22, 23, 24, 25, 64, 65]}
MOBILE_CHANNELS = [21, 23, 25, 28, 81, 85, 55, 65, 52, 38, 78]
DEFAULT_SOURCE = 6

LOOKBACK_DAYS = 14
FLAGS = ["item", "brand", "coop", "seller", "seller_item", "seller_brand", "seller_coop"]


def channel_dim(spark: SparkSession) -> DataFrame:
    """Channel id -> (is_pla, source_id, is_mobile); built from the fixed lists (tens of rows)."""
    codes = sorted({c for v in AD_TYPE_CHANNELS.values() for c in v} | {c for v in SOURCE_CHANNELS.values() for c in v}
                   | set(MOBILE_CHANNELS))
    rows = []
    for ch in codes:
        ad_type = next((t for t, v in AD_TYPE_CHANNELS.items() if ch in v), 0)
        source = next((s for s, v in SOURCE_CHANNELS.items() if ch in v), DEFAULT_SOURCE)
        rows.append((str(ch), ad_type, source, 1 if ch in MOBILE_CHANNELS else 0))
    return spark.createDataFrame(rows, "channel_id string, is_pla int, source_id int, is_mobile int")


def decode_channel(df: DataFrame, channel_col: str = "channel_id") -> DataFrame:
    """Attach ad type, source and mobile flag by one broadcast join (op B23); unknown -> 0 / 6 / 0."""
    dim = F.broadcast(channel_dim(df.sparkSession)).withColumnRenamed("channel_id", "_ch")
    j = df.join(dim, F.col(channel_col) == F.col("_ch"), "left").drop("_ch")
    return j.withColumns({"is_pla": F.coalesce("is_pla", F.lit(0)),
                          "source_id": F.coalesce("source_id", F.lit(DEFAULT_SOURCE)),
                          "is_mobile": F.coalesce("is_mobile", F.lit(0))})


def _int_text(x: Column) -> Column:
    """Drop leading zeros via an int round trip; null when not an int (S: try_cast)."""
    return x.try_cast("int").cast("string")


def channel_params_cols(params: DataFrame) -> dict[str, Column]:
    """Config values as scalar subqueries over the one-row config table (op C13), no cross join."""
    return {c: params.select(c).scalar() for c in ("id_regex", "channel_pos", "adid_length")}


def _form(id_text: Column, id_regex: Column) -> Column:
    """The grammar of a tracking id: ``pla``, ``lia``, ``old`` (the configured one), null if it has none.

    The configured pattern is no constant and is compiled for each value that meets it, so it comes last.
    """
    return F.when(id_text.rlike(PLA_ID), "pla").when(id_text.rlike(LIA_ID), "lia").when(F.regexp_like(id_text, id_regex), "old")


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once a row: out of a generator, so no later expression or filter repeats what is behind them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def parse_visits(visits: DataFrame, params: DataFrame) -> DataFrame:
    """Visit-side touches: ad id, channel, item, seller, structure from tracking id and URL (ops B21, B22).

    A tracking id of no known form gives way to the reflector id; a visit without a tracking id is no touch.
    """
    p = channel_params_cols(params)
    tid, rid = F.col("tracking_id"), F.col("reflector_id")
    pos, length = p["channel_pos"], p["adid_length"]
    rows = _once(visits.where(tid.isNotNull()), _form=_form(tid, p["id_regex"]), _item_url=F.coalesce(url_param("page_url", "wl12"), F.lit("")))
    is_pla, is_new, legacy = F.col("_form") == "pla", F.col("_form").isin("pla", "lia"), F.col("_form") == "old"
    rows = _once(rows.where(F.length("_item_url") > 2),
                 adid=F.when(is_new, F.substr(tid, pos + 2)).when(legacy, _int_text(F.substr(tid, pos + 2, length)))
                 .otherwise(_int_text(F.substr(rid, pos + 2, length))),
                 channel_id=_int_text(F.substr(F.when(F.col("_form").isNotNull(), tid).otherwise(rid), pos, F.lit(2))))
    adid = F.col("adid")
    seller_url = F.coalesce(url_param(F.lower("page_url"), "selectedsellerid"), F.lit("0"))
    out = rows.select(
        "order_no", "page_url", "visit_epoch", "order_date", F.col("visit_day").alias("ad_date"), "tracking_id", "adid", "channel_id",
        F.when(is_pla, F.get(F.split(adid, "_"), 0)).otherwise(F.get(F.split("_item_url", "_"), 0)).alias("item_ad"),
        F.coalesce(F.when(is_pla, F.get(F.split(adid, "_"), 1)).otherwise(seller_url), F.lit("0")).alias("seller_ad"),
        F.when(is_new, "nas").otherwise("oas").alias("f_nas"))
    return out.withColumn("is_target_all", F.when(F.col("adid") == "0", 1).otherwise(0))


def parse_referrers(last_ref: DataFrame, params: DataFrame, legacy_xref: DataFrame) -> DataFrame:
    """Referrer-side touches, one per order, with the legacy id look-up (ops B22, C16, F4)."""
    p = channel_params_cols(params)
    rid = F.col("reflector_id")
    pos, length = p["channel_pos"], p["adid_length"]
    form, tail = F.col("_form"), F.substr(rid, pos + 2)
    is_new = form.isin("pla", "lia")
    rows = _once(last_ref, _form=_form(rid, p["id_regex"]))
    rows = _once(rows, adid=F.when(is_new, tail).when(form == "old", _int_text(F.substr(rid, pos + 2, length))).otherwise(tail))
    adid = F.col("adid")
    refs = rows.select(
        "order_no", "order_date", F.col("created_on").alias("ad_date"), "adid",
        F.lit(None).cast("string").alias("page_url"), F.lit(None).cast("bigint").alias("visit_epoch"),
        _int_text(F.substr(rid, pos, F.lit(2))).alias("channel_id"),
        F.when(is_new, F.get(F.split(adid, "_"), 0)).alias("item_ad"),
        F.when(form == "pla", F.get(F.split(adid, "_"), 1)).otherwise(F.lit("0")).alias("seller_ad"),
        F.when(is_new, "nas").otherwise("oas").alias("f_nas"))
    refs = dedup_first(refs, ["order_no"], ["order_date", "ad_date", "adid"])
    x = legacy_xref.groupBy("legacy_id").agg(F.max("item_id").alias("item_legacy"))
    refs = refs.join(x, F.col("adid").try_cast("int") == F.col("legacy_id"), "left").drop("legacy_id")
    refs = refs.withColumn("item_ad", F.coalesce("item_ad", "item_legacy")).drop("item_legacy")
    return refs.withColumn("is_target_all", F.when(F.col("adid") == "0", 1).otherwise(0))


def lookback(df: DataFrame, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Keep touches less than ``days`` before the order (op B25)."""
    return df.where(F.datediff("order_date", "ad_date") < days)


def decoded_visits(visits: DataFrame, params: DataFrame) -> DataFrame:
    v = decode_channel(parse_visits(visits, params)).where(F.col("is_pla") > 0)
    v = v.withColumn("item_ad", F.when(F.col("source_id") == 4, F.get(F.split("item_ad", "_"), 0))
                     .otherwise(F.col("item_ad")))
    return lookback(v)


def decoded_referrers(last_ref: DataFrame, params: DataFrame, legacy_xref: DataFrame) -> DataFrame:
    return decode_channel(parse_referrers(last_ref, params, legacy_xref))


def valid_orders_semi(visits: DataFrame, refs: DataFrame) -> DataFrame:
    """Visits restricted to orders the referrer feed knows (op C14)."""
    return visits.join(refs.select("order_no"), "order_no", "left_semi")


TOUCH_KEY = ["order_no", "channel_id", "adid", "order_date"]
TOUCH_ATTRS = ["ad_date", "item_ad", "seller_ad", "f_nas", "is_pla", "source_id", "is_mobile", "is_target_all",
               "page_url", "visit_epoch"]


def touch_merge(visits: DataFrame, refs: DataFrame) -> DataFrame:
    """Full outer merge on the touch key, visit side first for every attribute (ops C15, B25)."""
    v = visits.select(*TOUCH_KEY, *[F.col(a).alias(f"v_{a}") for a in TOUCH_ATTRS])
    r = refs.select(*TOUCH_KEY, *[F.col(a).alias(f"r_{a}") for a in TOUCH_ATTRS])
    m = v.join(r, TOUCH_KEY, "full")
    m = m.select(*TOUCH_KEY, *[F.coalesce(f"v_{a}", f"r_{a}").alias(a) for a in TOUCH_ATTRS])
    return lookback(m.where(F.col("is_pla") > 0))


def canonical_offer(touches: DataFrame, xref: DataFrame) -> DataFrame:
    """New-structure touches re-keyed by the offer cross-reference; old ones unchanged (op C17)."""
    x = xref.select(F.col("ad_id").alias("_x_ad"), F.col("item_id").alias("_x_item"),
                    F.col("seller_id").alias("_x_seller")).distinct()
    j = touches.join(x, (F.col("f_nas") == "nas") & (F.col("adid") == F.col("_x_ad")), "left")
    return j.withColumns({"item_ad": F.coalesce("_x_item", "item_ad"),
                          "seller_ad": F.coalesce("_x_seller", "seller_ad")}).drop("_x_ad", "_x_item", "_x_seller")


def order_lines(order_items: DataFrame) -> DataFrame:
    """One row per order line: GMV sums, max of attributes (op D14)."""
    return order_items.groupBy(F.col("order_nbr").alias("order_no"), "order_line_nbr").agg(
        F.sum("gmv_plcd").alias("gmv_plcd"), F.sum("gmv_order").alias("gmv_order"),
        F.max(brand_norm("brand")).alias("purchase_brand"), F.max("item_id").alias("item_purchase"),
        F.max("seller_id").alias("seller_purchase"), F.max("fulfilment").alias("fulfilment"))


def touch_lines(touches: DataFrame, lines: DataFrame) -> DataFrame:
    """Every touch of an order meets every line of it (op C18).

    The plain product, for whoever wants all pairs; ``attribution`` makes only the related ones.
    """
    return touches.join(lines, "order_no", "inner")


def promo_tables(promo: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Item-level and offer-level promo event ids (op C19)."""
    item_level = (promo.where((F.col("source_id") == 4) | F.col("seller_id").isNull())
                  .groupBy("item_id").agg(F.max("event_id").alias("event_item")))
    offer_level = (promo.where((F.col("source_id") == 2) & F.col("seller_id").isNotNull())
                   .groupBy("item_id", "seller_id").agg(F.max("event_id").alias("event_offer")))
    return item_level, offer_level


def promo_event(df: DataFrame, promo: DataFrame, side: str) -> DataFrame:
    """``event_<side>``: the offer-level event id of (item, seller) first, the item-level one second (op C19, S16)."""
    item, seller = f"item_{side}", f"seller_{side}"
    item_level, offer_level = promo_tables(promo)
    il = item_level.select(F.col("item_id").alias("_i"), F.col("event_item").alias("_ei"))
    ol = offer_level.select(F.col("item_id").alias("_oi"), F.col("seller_id").alias("_os"), F.col("event_offer").alias("_eo"))
    return (df.join(il, F.col(item) == F.col("_i"), "left")
            .join(ol, (F.col(item) == F.col("_oi")) & (F.col(seller) == F.col("_os")), "left")
            .withColumn(f"event_{side}", F.coalesce("_eo", "_ei")).drop("_i", "_ei", "_oi", "_os", "_eo"))


def ad_side(touches: DataFrame, item_brands: DataFrame, promo: DataFrame) -> DataFrame:
    """Touches with the advertised item's brand and event; ``item_brands`` holds one row an item."""
    brands = item_brands.select(F.col("item_id").alias("item_ad"), F.col("brand").alias("ad_brand"))
    return promo_event(touches.join(brands, "item_ad", "left"), promo, "ad")


def purchase_side(lines: DataFrame, promo: DataFrame) -> DataFrame:
    """Order lines with the purchased item's event."""
    return promo_event(lines, promo, "purchase")


def _eq_flag(a: str, b: str) -> Column:
    return F.when(F.col(a) == F.col(b), 1).otherwise(0)


def relation_flags(pairs: DataFrame) -> DataFrame:
    """Same item / brand / promo event / seller and seller-combined flags; keep related pairs (ops B26, B27)."""
    same_coop = F.when((F.col("event_ad") == F.col("event_purchase")) & F.col("event_ad").isNotNull(), 1).otherwise(0)
    df = pairs.withColumns({
        "same_item": _eq_flag("item_purchase", "item_ad"), "same_brand": _eq_flag("purchase_brand", "ad_brand"),
        "same_coop": same_coop, "same_seller": _eq_flag("seller_purchase", "seller_ad")})
    both = lambda x: F.when((F.col("same_seller") == 1) & (F.col(f"same_{x}") == 1), 1).otherwise(0)
    df = df.withColumns({"same_seller_item": both("item"), "same_seller_brand": both("brand"),
                         "same_seller_coop": both("coop"),
                         "purchase_1p": F.when(F.col("seller_purchase") == "0", 1).otherwise(0)})
    return df.where(F.col("same_item") + F.col("same_brand") + F.col("same_coop") + F.col("same_seller") > 0)


# Relation -> its column on the ad side and on the purchase side, in the order in which a pair is given to one of them.
SIDES = {"item": ("item_ad", "item_purchase"), "brand": ("ad_brand", "purchase_brand"),
         "coop": ("event_ad", "event_purchase"), "seller": ("seller_ad", "seller_purchase")}


def _values(side: int, relations: list[str]) -> dict[str, Column]:
    """The text by which a touch (side 0) or a line (side 1) takes part in each relation; null if it cannot."""
    one = lambda r: F.col(SIDES[r][side]).cast("string")
    seller = one("seller")
    with_seller = lambda r: F.concat(F.length(seller).cast("string"), F.lit(":"), seller, one(r))
    return {r: one(r) if r in SIDES else with_seller(r.removeprefix("seller_")) for r in relations}


def by_relation(df: DataFrame, side: int, relations: list[str]) -> DataFrame:
    """A row of df once per relation in which it has a value, with columns ``relation`` and ``value``."""
    keys = F.array(*[F.struct(F.lit(r).alias("relation"), v.alias("value")) for r, v in _values(side, relations).items()])
    return df.select("*", F.inline(F.filter(keys, lambda k: k["value"].isNotNull())))


RELATION_KEY = ["order_no", "relation", "value"]


def related_pairs(touches: DataFrame, lines: DataFrame) -> DataFrame:
    """Pairs of a touch and a line of its order with at least one relation, and their flags (ops C18, B26, B27).

    Both sides meet on (order, relation, value); a pair with several relations
    stays under the first of them, so each pair comes out once.
    """
    base = list(SIDES)
    met = relation_flags(by_relation(touches, 0, base).join(by_relation(lines, 1, base), RELATION_KEY))
    first = F.coalesce(*[F.when(F.col(f"same_{r}") == 1, F.lit(r)) for r in base])
    return met.where(F.col("relation") == first).drop("relation", "value")


def claims(touches: DataFrame, lines: DataFrame) -> DataFrame:
    """Related pairs with ``num_claimants_<relation>``: touches that claim the line under it, 0 where the flag is 0 (ops C20, D15).

    A touch that claims a line is one of its related pairs, so these pairs hold
    every count: one more shuffle of the pairs, none of lines or touches. Lines
    are unique by order and number.
    """
    return claimant_counts(related_pairs(touches, lines))


def claimant_counts(flagged: DataFrame) -> DataFrame:
    """The counts of ``claims`` from pairs that are already there: one window over the order line, which spills beyond its buffer."""
    line = Window.partitionBy("order_no", "order_line_nbr")
    return flagged.withColumns({
        f"num_claimants_{f}": F.when(F.col(f"same_{f}") == 1, F.sum(f"same_{f}").over(line).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint")) for f in FLAGS})


#: Orders with more rows of a feed than this are crowded.
CROWDED_ROWS = 256


def crowded_orders(*orders: DataFrame, most: int = CROWDED_ROWS) -> DataFrame:
    """``order_no`` of the orders with more than ``most`` rows in one of the frames."""
    counted = [o.groupBy("order_no").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select("order_no") for o in orders]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


def claims_by_order(touches: DataFrame, lines: DataFrame, crowded: DataFrame) -> DataFrame:
    """``claims`` of all orders, those of ``crowded`` by relation and the others as a whole.

    Other orders have few rows, so their pairs are made and counted where the
    order's touches and lines meet: each row is shuffled once instead of once a
    relation, and the pairs are not. Which orders are crowded changes no result.
    """
    whole = relation_flags(touch_lines(touches.join(crowded, "order_no", "left_anti"), lines))
    by_value = claims(touches.join(crowded, "order_no", "left_semi"), lines.join(crowded, "order_no", "left_semi"))
    return claimant_counts(whole).unionByName(by_value)


OUTPUT = ["order_no", "order_line_nbr", "order_date", "ad_date", "adid", "channel_id", "source_id", "is_pla",
          "is_mobile", "is_target_all", "f_nas", "item_ad", "seller_ad", "ad_brand", "item_purchase", "seller_purchase",
          "purchase_brand", "purchase_1p", "event_ad", "event_purchase", "gmv_plcd", "gmv_order", "fulfilment",
          "page_url", "visit_epoch", "days_before",
          *[f"same_{f}" for f in FLAGS], *[f"num_claimants_{f}" for f in FLAGS]]


def attribution(visits: DataFrame, last_ref: DataFrame, params: DataFrame, legacy_xref: DataFrame, xref: DataFrame,
                order_items: DataFrame, item_brands: DataFrame, promo: DataFrame) -> DataFrame:
    """The whole order-attribution pipeline (op J1)."""
    refs = decoded_referrers(last_ref, params, legacy_xref)
    vis = valid_orders_semi(decoded_visits(visits, params), refs)
    touches = ad_side(canonical_offer(touch_merge(vis, refs), xref), item_brands, promo)
    crowded = crowded_orders(visits.select("order_no"), order_items.select(F.col("order_nbr").alias("order_no")))
    out = claims_by_order(touches, purchase_side(order_lines(order_items), promo), crowded)
    return out.withColumn("days_before", F.datediff("order_date", "ad_date")).select(*OUTPUT)
