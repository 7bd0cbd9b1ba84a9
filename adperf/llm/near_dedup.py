"""Operator 7: near-duplicate documents by MinHash bands and odd sketches.

Each document's set of word shingles gives ROWS * BANDS minimum hashes. Bands of
ROWS of them are the buckets in which candidates meet; all of them, folded into
a parity bitmap (an odd sketch), let the bits in which two sketches differ
estimate how alike two sets are, which throws out most candidates; the rest are
compared by their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import stored
from adperf.llm.components import components
from adperf.llm.shingles import WORDS, mixed, shingle_sets

#: Two sets with a likeness of 0.75 meet in no band with a chance of (1 - 0.75 ** ROWS) ** BANDS, 2 in 100,000.
ROWS, BANDS = 5, 40
SKETCH_BITS = 512
#: Candidates whose sketches say less are dropped: more than four and a half standard deviations under 0.75.
LEAST_ESTIMATE = 0.55
#: Documents of a bucket that one task compares at a time; larger buckets are compared block by block.
BLOCK = 1024
SIGNATURE = "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>, sketch array<long>"


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(75)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 64, n, dtype=np.uint64)


def minimums(hashes: np.ndarray, offsets: np.ndarray, n: int, block: int = 1 << 15) -> np.ndarray:
    """(sets, n) minimum hashes of non-empty sets; only some blocks of sets are at work at a time, to stay in cache."""
    out = np.empty((len(offsets) - 1, n), np.uint64)
    factors, masks = _multipliers(n)
    first = 0
    while first < len(offsets) - 1:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + block, "right")) - 1)
        part, at = hashes[offsets[first]:offsets[end]], offsets[first:end] - offsets[first]
        for j in range(n):
            out[first:end, j] = np.minimum.reduceat((part ^ masks[j]) * factors[j], at)
        first = end
    return out


def odd_sketches(least: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """(sets, bits / 64) parity bitmaps of minimum hashes: each toggles one bit."""
    n, k = least.shape
    bit = (mixed(least + np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) % np.uint64(bits)).astype(np.int64)
    where = (np.arange(n, dtype=np.int64)[:, None] * bits + bit).ravel()
    odd = (np.bincount(where, minlength=n * bits) & 1).astype(np.uint8).reshape(n, bits)
    return np.packbits(odd, axis=1).view(np.uint64)


def estimate(differing: np.ndarray, samples: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """Likeness of two sets from the number of bits in which their sketches differ."""
    left = np.maximum(1 - 2 * differing / bits, 1e-9)
    return 1 + bits / (4 * samples) * np.log(left)


def _signatures(rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, offsets = shingle_sets(b.column(1))
            n = np.diff(offsets)
            full = np.flatnonzero(n)
            least = minimums(hashes, np.concatenate((offsets[full], offsets[-1:])), rows * bands)
            salt = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            key = np.zeros((len(full), bands), np.uint64) + salt
            for r in range(rows):
                key = mixed(key ^ least[:, r::rows])
            tags = mixed(hashes + np.uint64(1))
            s1, s2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            if len(full):
                s1[full], s2[full] = np.add.reduceat(tags, offsets[full]), np.bitwise_xor.reduceat(tags * np.uint64(0xD6E8FEB86659FD93), offsets[full])
            words = SKETCH_BITS // 64
            lists = lambda values, each: pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum((n > 0) * each))), pa.int32()), pa.array(values.view(np.int64).ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), lists(key, bands), lists(odd_sketches(least), words)], names=[x.split(" ")[0] for x in SIGNATURE.split(", ")])

    return run


def signatures(docs: DataFrame, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """Per row of docs (doc_id, text): size and digests of its shingle set, band keys and odd sketch (empty for an empty set)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_signatures(rows, bands), SIGNATURE)


def _estimated(a: Column, b: Column, samples: int) -> Column:
    differing = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    return F.lit(1.0) + F.lit(SKETCH_BITS / (4 * samples)) * F.log(F.greatest(F.lit(1.0) - differing * F.lit(2.0 / SKETCH_BITS), F.lit(1e-9)))


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with both texts, those whose full sets are alike: 100 * common >= 75 * all."""
    for b in batches:
        (hx, ox), (hy, oy) = shingle_sets(b.column(2)), shingle_sets(b.column(3))
        keep = []
        for i in range(b.num_rows):
            x, y = hx[ox[i]:ox[i + 1]], hy[oy[i]:oy[i + 1]]
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(common > 0 and 100 * common >= 75 * (len(x) + len(y) - common))
        kept = b.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        yield kept


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (x, y) whose texts' full sets are alike."""
    x = pairs.join(texts.select(F.col("doc_id").alias("x"), F.col("text").alias("text_x")), "x")
    both = x.join(texts.select(F.col("doc_id").alias("y"), F.col("text").alias("text_y")), "y")
    return both.select("x", "y", "text_x", "text_y").mapInArrow(_alike, "x long, y long").distinct()


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[dict]:
    """Rows sorted by (bucket, i, j), one dictionary of arrays for each of these keys."""

    def whole(group: list[dict]) -> dict:
        return {k: np.concatenate([g[k] for g in group]) if k != "set" else [x for g in group for x in g[k]] for k in group[0]}

    group: list[dict] = []
    for b in batches:
        if not b.num_rows:
            continue
        c: dict = {n: np.asarray(b.column(n)) for n in names}
        c["sketch"] = np.asarray(b.column("sketch").flatten()).view(np.uint64).reshape(b.num_rows, -1)
        if "set" in b.schema.names:
            flat, at = np.asarray(b.column("set").flatten()).view(np.uint64), np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(b.column("set"))))))
            c["set"] = [flat[x:y] for x, y in zip(at, at[1:], strict=False)]
        key = np.stack([c["bucket"], c["i"], c["j"]], 1)
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), b.num_rows]
        for s, e in zip(cuts, cuts[1:], strict=False):
            part = {k: v[s:e] for k, v in c.items()}
            if group and tuple(key[s]) != (group[-1]["bucket"][0], group[-1]["i"][0], group[-1]["j"][0]):
                yield whole(group)
                group = []
            group.append(part)
    if group:
        yield whole(group)


NAMES = ("bucket", "i", "j", "side", "id", "component")


def _estimates(g: dict, samples: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of x, places of the ys that its sketch likes, estimates), for x of the first block and ys of other components."""
    same = g["i"][0] == g["j"][0]
    one, two = np.flatnonzero(g["side"] == 0), np.flatnonzero(g["side"] == (0 if same else 1))
    for x in one.tolist():
        ys = two[two > x] if same else two
        ys = ys[g["component"][ys] != g["component"][x]]
        if len(ys):
            est = estimate(np.bitwise_count(g["sketch"][ys] ^ g["sketch"][x]).sum(axis=1, dtype=np.int64), samples)
            if len(good := np.flatnonzero(est >= LEAST_ESTIMATE)):
                yield x, ys[good], est[good]


def _likely(samples: int):
    """Of the rows of a block pair, those that have a likely partner in another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, NAMES):
            mark = np.zeros(len(g["id"]), bool)
            for x, ys, _ in _estimates(g, samples):
                mark[x] = True
                mark[ys] = True
            if mark.any():
                sketch = pa.array(list(g["sketch"][mark].view(np.int64)), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(pa.array(g[n][mark]) for n in NAMES), sketch], names=[*NAMES, "sketch"])

    return run


def _linked(samples: int):
    """Links between the components of a block pair: likely pairs, the likeliest first, compared by their full sets until they are in one component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, (*NAMES,)):
            root: dict[int, int] = {}

            def find(c: int, root: dict = root) -> int:
                while root.get(c, c) != c:
                    c = root[c]
                return c

            xs, ys, sets, component = [], [], g["set"], g["component"].tolist()
            pairs = sorted(((-e, x, y) for x, many, es in _estimates(g, samples) for y, e in zip(many.tolist(), es.tolist(), strict=True)))
            for _, x, y in pairs:
                a, b = find(component[x]), find(component[y])
                if a == b or 100 * min(len(sets[x]), len(sets[y])) < 75 * max(len(sets[x]), len(sets[y])):
                    continue
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * common >= 75 * (len(sets[x]) + len(sets[y]) - common):
                    root[max(a, b)] = min(a, b)
                    xs.append(max(g["id"][x], g["id"][y]))
                    ys.append(min(g["id"][x], g["id"][y]))
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], names=["x", "y"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text) to their shingle sets."""
    for b in batches:
        hashes, offsets = shingle_sets(b.column(1))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64))).cast(pa.list_(pa.int64()))], names=["id", "set"])


def _leftover(near: DataFrame, known: DataFrame, sketches: DataFrame, texts: DataFrame, samples: int, block: int) -> DataFrame:
    """Links in buckets that still hold more than one component.

    A bucket of more than ``block`` documents is dealt to several tasks as pairs of
    blocks. First the sketches tell which documents have a likely partner; only those
    get their full sets, and a task emits the links that join components, never its pairs.
    """
    rows = near.join(known.withColumnRenamed("id", "cid"), "cid", "left").select("bucket", "cid", F.coalesce("component", "cid").alias("component"))
    several = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    rows = rows.join(several, "bucket").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.join(sketches, "cid").select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), F.col("cid").alias("id"), "component", "sketch")
    key = ["bucket", "i", "j"]
    likely = stored(rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(_likely(samples), "bucket long, i int, j int, side int, id long, component long, sketch array<long>"), "likely")
    sets = texts.join(likely.select(F.col("id").alias("doc_id")).distinct(), "doc_id").select("doc_id", "text").mapInArrow(_sets, "id long, set array<long>")
    return likely.join(sets, "id").select(*NAMES, "sketch", "set").repartition(*key).sortWithinPartitions(*key).mapInArrow(_linked(samples), "x long, y long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS, bands: int = BANDS, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * common >= 75 * all of their sets of five-word
    shingles; component_id is the smallest doc_id reachable, kept says that it is
    the row's own. Null, empty and wordless texts have an empty set and no link.
    Rows with one id are one document of several texts; a null id has no component and is kept.

    Documents of equal sets are one class, found by an aggregate. In round one
    each class of a bucket is compared with the bucket's least id only. In round
    two the buckets that still hold several components are looked at: of every
    pair that passes the sketches the full sets are compared, unless the two are in
    one component by then. No round emits all pairs of a bucket.
    """
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    samples = rows * bands
    sig = stored(signatures(text, rows, bands), "signatures")
    sets = sig.where("doc_id is not null and n_shingles > 0")
    classes = sets.groupBy("s1", "s2", "n_shingles").agg(F.min(F.struct("doc_id", "sketch", "bands")).alias("least"))
    # Tables, so that the joins with them can be split where a key is hot.
    classes = stored(classes.select("s1", "s2", "n_shingles", F.col("least.doc_id").alias("cid"), "least.sketch", "least.bands"), "classes")
    sketches = classes.select("cid", "sketch")
    member = classes.select("cid", F.explode("bands").alias("bucket"))
    full = stored(member.groupBy("bucket").agg(F.min("cid").alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n"), "full")
    near = stored(member.join(full, "bucket"), "buckets")
    texts = stored(text.join(near.select(F.col("cid").alias("doc_id")).distinct(), "doc_id"), "texts")

    pairs = near.where("cid <> pivot").select(F.col("cid").alias("x"), F.col("pivot").alias("y")).distinct()
    pairs = pairs.join(sketches.select(F.col("cid").alias("x"), F.col("sketch").alias("a")), "x").join(sketches.select(F.col("cid").alias("y"), F.col("sketch").alias("b")), "y")
    links = stored(_verified(pairs.where(_estimated(F.col("a"), F.col("b"), samples) >= LEAST_ESTIMATE).select("x", "y"), texts), "verified")
    # A class's other ids, and ids of several classes, are linked to the class.
    same = sets.join(classes.select("s1", "s2", "n_shingles", "cid"), ["s1", "s2", "n_shingles"]).select(F.col("doc_id").alias("x"), F.col("cid").alias("y")).where("x <> y")
    links = links.unionAll(stored(_leftover(near, components(links), sketches, texts, samples, block), "verified"))
    found = components(links.unionAll(same)).withColumnRenamed("id", "doc_id")
    out = sig.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
