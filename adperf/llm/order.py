"""The next row in the order of an id, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The ids are cut into so many ranges of near equal count; each is one window group.
RANGES = 512


def id_range(id_col: Column, cuts: list[int]) -> Column:
    """Number of the range of an id: how many cuts are not above it."""
    return F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in cuts]), lambda x: x <= id_col)) if cuts else F.lit(0)


def cyclic_next(ids: DataFrame, col: str, ranges: int = RANGES) -> DataFrame:
    """ids (distinct, not null) with ``next``: the next larger id; after the largest the smallest.

    Quantile cuts, from a mergeable sketch, make ranges of near equal count. Within
    a range a window finds the next id; the last of a range gets the first id of the
    next range that holds any, from a table of one row a range.
    """
    found = ids.agg(F.percentile_approx(col, [i / ranges for i in range(1, ranges)]).alias("cuts"), F.min(col).alias("least")).first()
    if found["least"] is None:
        return ids.withColumn("next", F.lit(None).cast("long"))
    cuts = sorted(set(found["cuts"] or []))
    dealt = ids.withColumn("range", id_range(F.col(col), cuts))
    firsts = dealt.groupBy("range").agg(F.min(col).alias("first"))
    after = firsts.select("range", F.lead("first").over(Window.orderBy("range")).alias("after"))
    within = dealt.withColumn("next", F.lead(col).over(Window.partitionBy("range").orderBy(col)))
    return within.join(after, "range").withColumn("next", F.coalesce("next", "after", F.lit(found["least"]))).drop("range", "after")
