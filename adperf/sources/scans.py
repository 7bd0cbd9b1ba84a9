"""Snapshot and window scans (ops A1, A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adperf.functions.windows import DayWindow, window_filter


def latest_snapshot(df: DataFrame, part_col: str = "ts") -> DataFrame:
    """Rows of the newest snapshot only (op A1).

    A scalar subquery on the partition column: on a partitioned table the
    planner turns it into a runtime partition filter, so only the newest
    partition is read; nothing goes through the driver.
    """
    newest = df.select(F.max(part_col)).scalar()
    return df.where(F.col(part_col) == newest)


def window_scan(df: DataFrame, day_col: str, anchor: str, window: DayWindow,
                excluded: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Rows whose day falls in the window, minus excluded days (op A2)."""
    return df.where(window_filter(day_col, anchor, window, excluded))


def newest_partition(spark: SparkSession, table: str, part_col: str = "ts"):
    """Greatest value of a partition column of a catalog table, from the catalog's list of partitions (op A1); None without partitions.

    No data file is opened. Values are compared as the column's type (9 before
    10), and partitions without a value are passed over. One value reaches the
    driver.
    """
    value = F.regexp_extract("partition", rf"(?:^|/){part_col}=([^/]*)", 1)
    plain = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))  # special characters are escaped in the list
    kind = spark.table(table).schema[part_col].dataType
    listed = spark.sql(f"show partitions {table}").where(value != "__HIVE_DEFAULT_PARTITION__")
    return listed.agg(F.max(plain.cast(kind))).first()[0]


def newest_snapshot(spark: SparkSession, table: str, part_col: str = "ts") -> DataFrame:
    """Rows of the newest partition of a catalog table; only its folder is read (op A1). Without partitions: no rows."""
    return spark.table(table).where(F.col(part_col) == F.lit(newest_partition(spark, table, part_col)))
