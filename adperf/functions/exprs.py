"""Small column expressions shared by the operators (ops B3-B9, B14, B15, B19-B25)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AD_KEY = ["ad_id", "source_id", "is_mobile"]
OFFER_KEY = ["item_id", "seller_id"]


def c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num: str | Column, den: str | Column) -> Column:
    """Null on a zero or null divisor, never an error (semantics S1)."""
    return F.try_divide(c(num), c(den))


def ad_item(ad_id: str | Column = "ad_id") -> Column:
    """Item id = first ``_`` token of the ad id (op B3); null when empty."""
    return F.get(F.split(c(ad_id), "_"), 0)


def brand_norm(brand: str | Column) -> Column:
    """Strip non-alphanumerics and lower-case (op B5)."""
    return F.lower(F.regexp_replace(c(brand), r"[^0-9A-Za-z]", ""))


def scrub_tabs(x: str | Column) -> Column:
    """Remove tab characters from category labels (op B6)."""
    return F.regexp_replace(c(x), "\t", "")


def not_sentinel(x: str | Column) -> Column:
    """Not null, not empty, not the ``\\N`` null marker (op B8)."""
    x = c(x)
    return x.isNotNull() & (x != "") & (x != "\\N")


def first_of(arr: str | Column) -> Column:
    """First element of an array, null when absent (op B7)."""
    return F.get(c(arr), 0)


def nested_value(arr: str | Column, *path: str) -> Column:
    """``arr[0][k1][k2]...`` with null for a missing element or key (op B7)."""
    out = first_of(arr)
    for k in path:
        out = F.try_element_at(out, F.lit(k))
    return out


def flag(cond: Column) -> Column:
    """Integer indicator 1/0 (op B9); a null condition counts as 0."""
    return F.when(cond, 1).otherwise(0)


def numeric(x: str | Column) -> Column:
    """Lenient numeric coercion: anything unparsable becomes null (op B14)."""
    return F.expr(f"try_cast({x} as double)") if isinstance(x, str) else x.try_cast("double")


def canonical_id(x: str | Column) -> Column:
    """Integer-normalised id text: ``'00123.0'`` -> ``'123'``; null if not numeric (op B15)."""
    return c(x).try_cast("decimal(38,0)").cast("string")


def clip_zero(x: str | Column) -> Column:
    """Clip at zero, keep null (op B20)."""
    x = c(x)
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))


def url_param(url: str | Column, key: str) -> Column:
    """Query parameter of a URL, null on a bad URL (op B21)."""
    return F.try_parse_url(c(url), F.lit("QUERY"), F.lit(key))


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond) if cond is not None else df


def is_dst(day, tz: str = "America/Los_Angeles") -> bool:
    """Whether daylight saving time is in force at noon of ``day`` in ``tz`` (op B24)."""
    import datetime as _dt
    from zoneinfo import ZoneInfo
    d = day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day))
    return bool(_dt.datetime(d.year, d.month, d.day, 12, tzinfo=ZoneInfo(tz)).dst())


def local_day_fixed(gmt_ts: str | Column, anchor_day, tz: str = "America/Los_Angeles") -> Column:
    """GMT timestamp -> local day using the anchor day's offset for every row (op B24, S23)."""
    hours = 7 if is_dst(anchor_day, tz) else 8
    return F.to_date(c(gmt_ts) - F.expr(f"INTERVAL {hours} HOURS"))


def local_day_exact(gmt_ts: str | Column, tz: str = "America/Los_Angeles") -> Column:
    """GMT wall-clock timestamp -> local day with each row's own offset (op B24)."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), c(gmt_ts).cast("timestamp_ntz")))
