"""Operator 9: sharding by best-fit-decreasing bin packing.

Groups of equal texts are indivisible. Spark sums them, sorts them by size and
packs them, partition by partition, into bundles of a fixed capacity: each
group enters the tightest bundle that still holds it, found in a balanced tree
of the remaining capacities. The bundles (a bounded number, whatever the input)
are then packed the same way into the shards.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adperf.llm.common import stored, text_key

#: Bundles a shard: about so many, each an equal part of a shard's bytes.
BUNDLES = 64
#: Tasks that pack groups into bundles, and parts of a shard that are numbered in one task each.
PARTS = 64


class CapacityTree:
    """A balanced tree (a treap) of (remaining capacity, bin), with the least one of at least a given capacity."""

    def __init__(self) -> None:
        self.root: list | None = None
        self.rank = random.Random(0).random

    def add(self, capacity: int, bin_id: int) -> None:
        below, above = self._split(self.root, (capacity, bin_id))
        self.root = self._join(self._join(below, [(capacity, bin_id), self.rank(), None, None]), above)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the smallest (capacity, bin) with capacity >= size, if there is one."""
        node, found = self.root, None
        while node:
            if node[0][0] >= size:
                found, node = node[0], node[2]
            else:
                node = node[3]
        if found:
            below, rest = self._split(self.root, found)
            _, above = self._split(rest, (found[0], found[1] + 1))
            self.root = self._join(below, above)
        return found

    def _split(self, node, key):
        """Nodes under key, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            below, above = self._split(node[3], key)
            node[3] = below
            return node, above
        below, above = self._split(node[2], key)
        node[2] = above
        return below, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b


class BestFit:
    """Bins of a fixed capacity, opened as needed; a larger item gets a bin of its own, which is then full."""

    def __init__(self, capacity: int, most: int | None = None) -> None:
        self.capacity, self.most, self.bins, self.tree = capacity, most, 0, CapacityTree()

    def place(self, size: int) -> int | None:
        """Bin of the item; None if it fits in none and no more may be opened."""
        spot = self.tree.take_tightest(size)
        if spot is None:
            if self.most is not None and (self.bins >= self.most or size > self.capacity):
                return None
            spot = (max(self.capacity, size), self.bins)
            self.bins += 1
        if spot[0] > size:
            self.tree.add(spot[0] - size, spot[1])
        return spot[1]


def least_capacity(sizes: list[int], bins: int) -> tuple[int, list[int]]:
    """The least capacity (found by halving) at which best fit decreasing needs ``bins`` bins at most, and each item's bin. sizes descend."""

    def tried(capacity: int) -> list[int] | None:
        pack = BestFit(capacity, bins)
        out = []
        for s in sizes:
            if (b := pack.place(s)) is None:
                return None
            out.append(b)
        return out

    low = max([1, -(-sum(sizes) // bins), *sizes[:1]])
    high = low + max([0, *sizes[:1]])
    while (found := tried(high)) is None:
        high *= 2
    while low < high:
        mid = (low + high) // 2
        if (x := tried(mid)) is None:
            low = mid + 1
        else:
            high, found = mid, x
    return high, found


def shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text", bundles: int = BUNDLES, parts: int = PARTS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    A document's size is the UTF-8 bytes of its text (null: 0) plus 1; documents
    of equal text share a shard, null and empty texts being two groups. Repeated
    rows and ids are placed each. Shards hold near equal bytes as long as no
    group is larger than a shard. Groups are summed map-side, so that a hot one
    costs little; the driver gets ``n_shards * bundles * 2 + parts`` bundle sizes at
    most. Slots number a shard's documents without gaps, from counts by part.
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), *text_key(text))
    groups = rows.groupBy("k1", "k2").agg(F.sum("size").alias("bytes"))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    capacity = max(1, -(-total // (n_shards * bundles)))

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, pack = None, BestFit(capacity)
        for x in batches:
            found = []
            for p, size in zip(x["part"].tolist(), x["bytes"].tolist(), strict=True):
                if p != part:
                    part, pack = p, BestFit(capacity)
                found.append(pack.place(size))
            yield x.assign(bundle=found)[["part", "bundle", "k1", "k2", "bytes"]]

    dealt = groups.withColumn("part", F.pmod("k2", F.lit(parts)).cast("int")).repartition(parts, "part").sortWithinPartitions("part", F.desc("bytes"), "k1", "k2")
    packed = stored(dealt.mapInPandas(bundle, "part int, bundle long, k1 long, k2 long, bytes long"), "bundles")
    sums = packed.groupBy("part", "bundle").agg(F.sum("bytes").alias("bytes")).collect()
    sums.sort(key=lambda r: (-r.bytes, r.part, r.bundle))
    _, where = least_capacity([r.bytes for r in sums], n_shards) if sums else (0, [])
    places = docs.sparkSession.createDataFrame([(r.part, r.bundle, b) for r, b in zip(sums, where, strict=True)], "part int, bundle long, shard int")
    placed = packed.join(places, ["part", "bundle"]).select("k1", "k2", "shard")
    out = rows.join(placed, ["k1", "k2"]).withColumn("spread", F.pmod(F.xxhash64("doc_id", "k1"), F.lit(n_shards * parts)).cast("int"))
    counts = out.groupBy("shard", "spread").count().withColumn("before", F.sum("count").over(Window.partitionBy("shard").orderBy("spread").rowsBetween(Window.unboundedPreceding, -1)))
    within = F.row_number().over(Window.partitionBy("shard", "spread").orderBy("doc_id", "k1", "k2"))
    return (out.withColumn("within", within).join(counts.drop("count"), ["shard", "spread"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("within") - 1 + F.coalesce("before", F.lit(0))).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))

