"""Top-N, sorted export and keep-first de-duplication (ops F1-F4)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adperf.session import materialize


def topn(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """Global top-N by a total order (ops F1, F2), for an n too large for one task (TakeOrdered merges n rows of every partition in one).

    The rows are written by ranges of the order, and the ranges' counts tell in which
    of them the n-th row is: the ranges before are kept whole and only that one is cut,
    so no task gets more than a range. Sorting the result deals it by ranges again.
    """
    ranged = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "topn")
    before = 0
    for r in ranged.groupBy("_range").count().orderBy("_range").collect():
        if before + r["count"] > n:
            cut = ranged.where(F.col("_range") == r["_range"]).orderBy(*order).limit(n - before)
            ranged = ranged.where(F.col("_range") < r["_range"]).unionByName(cut)
            break
        before += r["count"]
    return ranged.drop("_range").orderBy(*order)


def null_count(cols: list[str]) -> Column:
    """Number of null values among ``cols`` (op F2)."""
    return sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))


def sorted_export(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """Globally sorted rows (op F3): range partitioning plus per-partition sort."""
    if partitions:
        return df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return df.orderBy(*order)


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key under a total order (op F4, S10).

    Written as a ``min(struct(order..., rest...))`` aggregate rather than a
    ``row_number`` window: it combines map-side, so a key holding a third of
    all rows is reduced before the shuffle instead of sorted in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + rest])


def ranked_values(df: DataFrame, cols: list[str], shares: list[float]) -> DataFrame:
    """(column, share, value): exact, interpolated quantiles of each column's values, null where it has none.

    Equal values are counted first, so a value that a third of the rows holds is
    one row. The counts are written by ranges of (column, value), the ranges' sums
    tell in which of them a rank is, and only there values are counted up. Only
    the ranges' sums reach the driver.
    """
    spark = df.sparkSession
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("_x")).select("_x.*").where("value is not null")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranged = materialize(counts.repartitionByRange("column", "value").withColumn("_range", F.spark_partition_id()), "values")
    sums: dict[str, list[tuple[int, int]]] = {}
    for r in ranged.groupBy("column", "_range").agg(F.sum("n").alias("n")).orderBy("column", "_range").collect():
        sums.setdefault(r["column"], []).append((r["_range"], r["n"]))
    wanted = []
    for column, parts in sums.items():
        last = sum(n for _, n in parts) - 1
        for share in shares:
            place = last * share
            for rank in {math.floor(place), math.ceil(place)}:
                before = 0
                for number, n in parts:
                    if rank < before + n:
                        wanted.append((column, share, number, rank - before, place - math.floor(place)))
                        break
                    before += n
    asked = spark.createDataFrame(wanted, "column string, share double, _range int, _rank long, _between double")
    upto = F.sum("n").over(Window.partitionBy("column", "_range").orderBy("value"))
    found = ranged.join(F.broadcast(asked.select("column", "_range").distinct()), ["column", "_range"], "left_semi").withColumn("_upto", upto)
    picked = asked.join(found, ["column", "_range"]).where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("n")))
    ends = picked.groupBy("column", "share").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.max("_between").alias("_between"))
    return ends.select("column", "share", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_between")).alias("value"))
