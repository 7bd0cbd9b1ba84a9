"""Operator 12: periodic runs of words.

A suffix automaton of a stretch of words is built; its suffix links form a tree
in which the prefixes' states are visited in the order of the words. Each visit
is an access of a link-cut tree: the path to the root becomes one preferred path
whose colour is the place of the last word. The pieces of older paths that it
takes over tell, piece by piece, the longest suffix that also ended at the older
place. Where that length is at least (exponent - 1) times the distance, the words
repeat with the distance as period, and comparing words on both sides extends
them to the whole run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run has so many words and periods at least.
MIN_WORDS, MIN_EXPONENT = 24, 3
RUNS = "array<struct<start:long,length:long,period:long>>"
_FAR = np.iinfo(np.int64).max
_FACTORS = np.random.default_rng(20240712).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def suffix_automaton(words: list) -> tuple[list[int], list[int], list[int]]:
    """(suffix link, longest length) of each state, the root being 0, and the state of each prefix."""
    link, longest, arcs = [0], [0], [{}]
    prefixes = []
    last = 0
    for w in words:
        state = len(link)
        link.append(0)
        longest.append(longest[last] + 1)
        arcs.append({})
        p = last
        while w not in arcs[p]:
            arcs[p][w] = state
            if p == 0:
                break
            p = link[p]
        else:
            q = arcs[p][w]
            if longest[q] == longest[p] + 1:
                link[state] = q
            else:
                twin = len(link)
                link.append(link[q])
                longest.append(longest[p] + 1)
                arcs.append(arcs[q].copy())
                link[q] = link[state] = twin
                while arcs[p].get(w) == q:
                    arcs[p][w] = twin
                    if p == 0:
                        break
                    p = link[p]
        last = state
        prefixes.append(state)
    return link, longest, prefixes


class PathColours:
    """A link-cut tree over a fixed rooted tree: preferred paths are splay trees, each with one colour, kept at its top.

    Node 0 stands for "none", so tree nodes are numbered from 1.
    """

    def __init__(self, parent: list[int]):
        n = len(parent)
        self.up = parent  # parent in the splay tree; at its top, the node above the path
        self.upper, self.lower = [0] * n, [0] * n
        self.colour = [0] * n

    def _splay(self, x: int) -> None:
        up, upper, lower = self.up, self.upper, self.lower
        while True:
            p = up[x]
            left = upper[p] == x
            if not p or not (left or lower[p] == x):
                return
            g = up[p]
            inner = bool(g) and (upper[g] == p or lower[g] == p)
            if inner and (upper[g] == p) == left:
                self._rotate(p, g)
            self._rotate(x, p)

    def _rotate(self, x: int, p: int) -> None:
        up, upper, lower = self.up, self.upper, self.lower
        g = up[p]
        if g:
            if upper[g] == p:
                upper[g] = x
            elif lower[g] == p:
                lower[g] = x
        if upper[p] == x:
            c = upper[p] = lower[x]
            lower[x] = p
        else:
            c = lower[p] = upper[x]
            upper[x] = p
        if c:
            up[c] = p
        up[p], up[x] = x, g
        # the colour stays with the top of the splay tree
        if not g or (upper[g] != x and lower[g] != x):
            self.colour[x] = self.colour[p]

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """Makes the path from x to the root one of the given colour; (deepest node, colour) of each piece it takes over, from below."""
        pieces = []
        node, below = x, 0
        while node:
            self._splay(node)
            if old := self.colour[node]:
                pieces.append((node, old))
            if deeper := self.lower[node]:
                self.colour[deeper] = old  # what hangs below leaves the path and keeps its colour
            self.lower[node] = below
            below, node = node, self.up[node]
        self._splay(x)
        self.colour[x] = colour
        return pieces


def stretch_runs(words: list, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of each run in a list of words, which may be of any hashable kind.

    Where a run ends, the place one period earlier is the last one at which the
    rest of the run ended before, so it shows as a piece of the path there.
    """
    n = len(words)
    if n < min_words:
        return []
    link, longest, prefixes = suffix_automaton(words)
    tree = PathColours([0, 0, *(x + 1 for x in link[1:])])
    found = []
    reached: dict[int, int] = {}  # by period: the end of the last run of that period
    for end, state in enumerate(prefixes, 1):
        for node, before in tree.access(state + 1, end):
            period, common = end - before, longest[node - 1]
            if common >= (min_exponent - 1) * period and reached.get(period, 0) < end:
                start, stop = end - common - period, end
                while start and words[start - 1] == words[start - 1 + period]:
                    start -= 1
                while stop < n and words[stop] == words[stop - period]:
                    stop += 1
                reached[period] = stop
                if stop - start >= min_words:
                    found.append((start, stop - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(hashes: np.ndarray, gram: int, exponent: int) -> list[tuple[int, int]]:
    """(start, end) of the parts of a text that can hold runs of ``exponent * gram`` words or more; the rest holds none.

    Each gram inside such a run stands there again one period away, so it has an
    equal one no farther than the run's length / exponent. Grams without one are
    left out, which makes the parts shorter, until nothing changes.
    """
    n = len(hashes) - gram + 1
    if n < 2:
        return []
    rolled = np.zeros(n, np.uint64)
    for i in range(gram):
        rolled += hashes[i:i + n] * _FACTORS[i % 64]
    order = np.argsort(rolled, kind="stable")
    ranked = rolled[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return []
    gaps = np.where(same, order[1:] - order[:-1], _FAR)
    far = np.full(n, _FAR)
    far[order[:-1]] = gaps
    far[order[1:]] = np.minimum(far[order[1:]], gaps)
    limit = np.full(n, len(hashes) // exponent)
    count = n + 1
    while True:
        keep = far <= limit
        now = int(keep.sum())
        if now == count or not now:
            break
        count = now
        edges = np.flatnonzero(np.diff(np.concatenate(([False], keep, [False]))))
        limit = np.zeros(n, np.int64)
        limit[keep] = np.repeat((edges[1::2] - edges[::2] + gram - 1) // exponent, edges[1::2] - edges[::2])
    edges = np.flatnonzero(np.diff(np.concatenate(([False], keep, [False]))))
    return [(int(a), int(b) + gram - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def runs(words: list[bytes], min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text's words, by start and period."""
    if len(words) < min_words:
        return []
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    out = []
    for a, b in stretches(hashes, max(1, min_words // min_exponent), min_exponent):
        out += [(a + start, length, period) for start, length, period in stretch_runs(words[a:b], min_words, min_exponent)]
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words joined by single spaces, without those that a run holds after its first period."""
    if found:
        gone = np.zeros(len(words), bool)
        for start, length, period in found:
            gone[start + period:start + length] = True
        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return b" ".join(words)


def find(text: Column, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> Column:
    """struct(n_words, runs, collapsed) of a whole text; words are runs of other characters than ASCII white space."""
    if min_exponent < 3 or min_words < min_exponent:
        raise ValueError("runs of fewer than three periods are not all found")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    @F.arrow_udf(f"n_words long, runs {RUNS}, collapsed string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            counts, every, rest = [], [], []
            for t in texts.cast(pa.large_binary()):
                words = (t.as_py() or b"").split()
                found = runs(words, min_words, min_exponent)
                counts.append(len(words))
                every.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                rest.append(collapsed(words, found))
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(every, kind), pa.array(rest, pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"])

    return run(text)


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period), collapsed.

    A run is a stretch of words whose smallest period q makes it ``min_words`` and
    ``min_exponent * q`` words long at least, and which no neighbour extends.
    Null, empty and blank texts have no words, no runs and an empty collapsed text.
    Repeated rows are searched each, other columns are ignored, a null id stays
    null, an empty table gives no rows. Very long texts are searched whole, in
    memory in proportion to their length. Row-local: no shuffle.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.withColumn("found", find(F.col("text"), min_words, min_exponent)).select("doc_id", "found.*")


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the loops that the query plants: h = crc32 of the decimal id; where 10 divides h, the words from
    a = g % n on repeat the first p of them, with g = h div 10, n words and p = 1 + (n - a) div (3 + g % 8). A null id has none."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    marked = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.when(marked, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words")).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.expr("case when n > 0 then int(g % n) end")).withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    loop = F.expr("array_join(transform(words, (x, i) -> case when i < a then x else element_at(words, int(a + (i - a) % p) + 1) end), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, loop).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The query's columns from what ``periodic_runs`` gives: of the runs, the one of greatest length / period, by start and period if equal."""
    best = F.expr("aggregate(runs, cast(null as struct<start:long,length:long,period:long>), (a, x) -> case when a is null or x.length * a.period > a.length * x.period then x else a end)")
    lines = F.expr("concat_ws('', transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')))")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
