"""Shared building blocks of the registered queries."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from adperf.functions.metrics import metric_spec
from adperf.operators import signals as S
from adperf.plans.params import UNIVERSE, ANCHOR
from adperf.plans.sqlkit import win
from adperf.sources.fixtures import TestTables


def tables(spark: SparkSession, sf_dir: str) -> TestTables:
    return TestTables(spark, sf_dir)


def universe(T: TestTables) -> DataFrame:
    return S.ad_universe(T.traffic_daily, T.offer_xref, T.ad_hierarchy_daily, T.item_dim, T.variant_map,
                         anchor=ANCHOR, window=UNIVERSE)


def metric_names(targets=("brand", "seller"), prefix: str = "", suffix: str = "") -> list[str]:
    return [f"{prefix}{m.name}{suffix}" for m in metric_spec(targets)]


@lru_cache(maxsize=1)
def universe_sql() -> str:
    """CTEs ``ads, hier, brands, universe, offers`` (SQL twin of ``universe``)."""
    u = win("ds", UNIVERSE, ())
    return f"""ads as (select distinct ad_id, source_id, is_mobile, seller_id as seller_traffic,
    split_part(ad_id, '_', 1) as item_parsed from traffic_daily where {u}),
hier as (select ad_id, max({{'ds': ds, {', '.join(f"'{c}': {c}" for c in S.HIERARCHY_COLS)}}}) as hs from ad_hierarchy_daily where {u} group by ad_id),
brands as (select item_id, max(lower(regexp_replace(brand, '[^0-9A-Za-z]', '', 'g'))) as brand
    from item_dim where ts = (select max(ts) from item_dim) group by item_id),
universe as (select a.ad_id, a.source_id, a.is_mobile, coalesce(x.item_id, a.item_parsed) as item_id,
    coalesce(x.seller_id, a.seller_traffic) as seller_id, b.brand,
    {', '.join(f"struct_extract(h.hs, '{c}') as {c}" for c in S.HIERARCHY_COLS)}, v.id_unique_variant
  from ads a left join offer_xref x on a.ad_id = x.ad_id
  left join hier h on a.ad_id = h.ad_id
  left join brands b on b.item_id = coalesce(x.item_id, a.item_parsed)
  left join variant_map v on v.item_id = coalesce(x.item_id, a.item_parsed)),
offers as (select distinct item_id, seller_id from universe)"""


UNIVERSE_FIXTURES = ("traffic_daily", "offer_xref", "ad_hierarchy_daily", "item_dim", "variant_map")
