"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder of ``spark.checkpoint.dir``.

    The setting is read from the session. Where it is unset a folder of our own
    is used, which is only right when driver and executors are one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a written table in the shared folder; it survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_key(c: Column) -> list[Column]:
    """Two independent 64-bit hashes of a text, as columns k1 and k2 (together the identity of a text)."""
    return [F.xxhash64(c).alias("k1"), F.xxhash64(F.lit("second key"), c).alias("k2")]


def by_bytes(items: Iterable, size, most: int) -> Iterator[list]:
    """Groups items in order, so that each group's sizes sum to ``most`` at most (a larger item stands alone)."""
    group: list = []
    total = 0
    for x in items:
        n = size(x)
        if group and total + n > most:
            yield group
            group, total = [], 0
        group.append(x)
        total += n
    if group:
        yield group
