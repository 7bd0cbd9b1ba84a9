"""Quantiles by range counts and label codes by ranges, against plain sorting."""

import random

import numpy as np
import pytest

from adperf.operators import evaluate as V
from adperf.operators import model as M
from adperf.operators.ordering import ranked_values

SHARES = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_quantiles(spark, partitions):
    rng = random.Random(int(partitions))
    rows = [(rng.choice([0.0, rng.random() * 100]), float(rng.randint(0, 3)) if rng.random() < 0.8 else None, None, 5.0 if i == 3 else None) for i in range(1001)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {(r["column"], r.share): r.value for r in ranked_values(df, ["a", "b", "c", "d"], SHARES).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for i, column in enumerate("abcd"):
        values = [r[i] for r in rows if r[i] is not None]
        for share in SHARES:
            assert got.get((column, share)) == (pytest.approx(np.quantile(values, share)) if values else None)


def test_summary_of_nothing(spark):
    df = spark.createDataFrame([], "a double, b int")
    got = V.numeric_summary(df, ["a", "b"], quartiles=True).collect()
    assert [(r["column"], r["count"], r.q50) for r in sorted(got)] == [("a", 0, None), ("b", 0, None)]


def test_labels_that_start_alike_are_dealt(spark):
    """All labels share their first letters; the largest task numbers a part of them only."""
    rng = random.Random(2)
    labels = ["Brand#" + "".join(rng.choices("abcdef", k=6)) for _ in range(3000)]
    rows = [(i, rng.choice(labels) if i % 10 else None) for i in range(9000)]
    df = spark.createDataFrame(rows, "id int, label string")
    got = {r.id: r.label_idx for r in M.label_encode(df, ["label"]).collect()}
    order = sorted({x for _, x in rows if x is not None})
    code = {x: i for i, x in enumerate(order)}
    assert all(got[i] == (len(order) if x is None else code[x]) for i, x in rows)
    assert M.label_encode(df.where("id < 0"), ["label"]).count() == 0
    spread = df.select("label").distinct().repartitionByRange(8, "label").groupBy(M.F.spark_partition_id()).count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 0.3 * len(order)
