"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) of each id in links (x, y): component is the smallest id reachable.

    Large-star and small-star steps in turn, until a step changes nothing; each
    step's links are a written table, so lineage stays short and an executor may
    be lost. Minima are aggregates that combine map-side, so an id with very many
    links costs no more than its links. Nothing but counts reaches the driver.
    """
    edges = stored(_facing_down(links.select(F.col("x").alias("u"), F.col("y").alias("v"))), "links")
    mark = _mark(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _facing_down(edges: DataFrame) -> DataFrame:
    """Each link once, from its larger id u to its smaller id v."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of an id are linked to the least id around it."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _facing_down(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of an id, and the id, are linked to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select("u", F.col("m").alias("v"))
    return _facing_down(edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(own))
