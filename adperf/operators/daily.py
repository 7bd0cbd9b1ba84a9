"""Daily partial sums as a stored table, and the windows of any anchor days from it (ops J3, B30, G2).

The daily facts are summed once to one row a key and day and written by month. A
later run adds months that are not there yet and reads nothing else of the
facts. Windows of several anchors come from the months their spans touch, in one
pass: a row goes to each anchor whose span holds its day, and is summed into the
segment of days between two windows' ends that it lies in.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adperf.functions.exprs import AD_KEY
from adperf.functions.metrics import metric_columns, metric_spec
from adperf.functions.names import LABEL_REMAP, FeatureName
from adperf.functions.windows import DayWindow, as_date, effective_days, segments
from adperf.operators.features import both_feeds, day_segment, segment_sums, window_base
from adperf.operators.signals import ATTR_MEASURES, TRAFFIC_MEASURES
from adperf.session import path_exists


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def months(lo: dt.date, hi: dt.date) -> list[str]:
    """The months from lo's to hi's."""
    first, last = lo.year * 12 + lo.month - 1, hi.year * 12 + hi.month - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)]


def stored_months(spark: SparkSession, path: str) -> list[str]:
    """Months of a daily table, from its folders alone."""
    if not path_exists(spark, path):
        return []
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    return sorted(s.getPath().getName().removeprefix("month=") for s in found if s.getPath().getName().startswith("month="))


def add_days(facts: DataFrame, path: str, day: str, measures: list[str], lo: dt.date, hi: dt.date, changed_since: dt.date | None = None) -> list[str]:
    """Adds the months of lo to hi that ``path`` lacks, and those from ``changed_since`` on; gives the months it wrote.

    Whole months are summed and replaced, so a second run changes nothing. Facts
    of other months are not read, where the facts can be pruned by day.
    """
    spark = facts.sparkSession
    have = set(stored_months(spark, path))
    since = changed_since.strftime("%Y-%m") if changed_since else None
    todo = [m for m in months(lo, hi) if m not in have or (since and m >= since)]
    if todo:
        first, last = as_date(f"{todo[0]}-01"), as_date(f"{todo[-1]}-28") + dt.timedelta(days=4)
        rows = facts.where(F.col(day).between(F.lit(first), F.lit(last)) & _month(F.col(day)).isin(todo))
        sums = rows.groupBy(*AD_KEY, F.col(day).alias("day")).agg(*[F.sum(m).alias(m) for m in measures])
        by_month = sums.withColumn("month", _month(F.col("day"))).repartition("month", F.pmod(F.xxhash64("ad_id"), F.lit(8)))  # a month is a few files, and no task
        by_month.sortWithinPartitions("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    return todo


def read_days(spark: SparkSession, path: str, lo: dt.date, hi: dt.date) -> DataFrame:
    """Daily sums of lo to hi; only the folders of their months are read."""
    return spark.read.parquet(path).where(F.col("month").isin(months(lo, hi)) & F.col("day").between(F.lit(lo), F.lit(hi))).drop("month")


def span(anchors: list[dt.date], windows: list[DayWindow]) -> tuple[dt.date, dt.date]:
    """First and last day of any window of any anchor."""
    bounds = [w.bounds(a) for a in anchors for w in windows]
    return min(lo for lo, _ in bounds), max(hi for _, hi in bounds)


def anchored_features(traffic_days: DataFrame, attributed_days: DataFrame, *, anchors: list[dt.date], windows: list[DayWindow], excluded=(), prefix: str = "sem_") -> DataFrame:
    """The attributed ad signal of all windows for each anchor: snapshot_date, ad key, ``sem_<metric>_<window>``.

    One shuffle of the daily rows whatever the number of anchors and windows:
    both feeds are dealt by ad as they are, and a row goes to the anchors whose
    span holds its day only then. Attributed measures count only where the ad
    has traffic in the window.
    """
    skipped = [F.lit(as_date(x)) for x in excluded]
    days = both_feeds(traffic_days, attributed_days).repartition(*AD_KEY)
    rows = (days.where(~F.col("day").isin(skipped)) if skipped else days).withColumn("snapshot_date", F.explode(F.array(*[F.lit(a) for a in anchors])))
    back = F.datediff("snapshot_date", "day")
    rows = rows.withColumn("_segment", day_segment(lambda near, far: back.between(near, far), windows)).where("_segment is not null")
    key = ["snapshot_date", *AD_KEY]
    wide = segment_sums(rows, key, windows, [F.sum(m).alias(m) for m in ("_n", *TRAFFIC_MEASURES, *ATTR_MEASURES)])
    found = F.coalesce(*[F.col(f"{i}__n") for i in range(len(segments(windows)))]).isNotNull()  # an ad without traffic has no row
    spec = metric_spec(("brand", "seller"))
    cols: list[Column] = []
    for w in windows:
        by_anchor = F.create_map(*[F.lit(x) for a in anchors for x in (a, effective_days(a, w, excluded))])
        cols += metric_columns(spec, window_base(w, windows), by_anchor[F.col("snapshot_date")], prefix, f"_{w.name}")
    return wide.where(found).select(*key, *cols)


def renamed_labels(df: DataFrame, remap: dict[str, str] | None = None) -> DataFrame:
    """Label columns of a snapshot under their common window name, ``l3`` as ``l`` (ops G2, B13); other columns stay."""
    remap = LABEL_REMAP if remap is None else remap
    names = {c: str(FeatureName(n.signal, n.metric, remap[n.window])) for c in df.columns if (n := FeatureName.parse(c)) and n.window in remap}
    return df.withColumnsRenamed(names)
