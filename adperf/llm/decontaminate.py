"""Operator 4: benchmark decontamination by pigeonhole edit matching.

An item of n characters may be found with up to n * rate errors. It is cut into
one piece more than that, so that one piece at least stands unchanged in each
match. Pieces are found exactly, with one automaton for all, and the text
around a hit is verified with Myers' bit-parallel edit distance.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import by_bytes

#: Errors allowed for each character of an item.
RATE = 1 / 16
#: Characters of items that go to the executors at once; the items are taken in blocks of so many.
BLOCK_CHARS = 1 << 21
HITS = "array<struct<item_id:long,distance:int,start:int,end:int>>"

Items = tuple[tuple[int, str], ...]


#: Each character's lower case, where that is one character.
_LOWER = {c: low for c in range(sys.maxunicode + 1) if (low := chr(c).lower()) != chr(c) and len(low) == 1}


def same_length_lower(text: str) -> str:
    """Lower case, character by character: one whose lower case is longer stays, and so do all places."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): errors + 1 pieces of near equal length that make up the item."""
    n, k = len(item), errors + 1
    cuts = [i * n // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(item: str, text: str) -> tuple[int, int]:
    """(distance, end): least edit distance of the item to any part of the text, and where the first such part ends."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        d0 = (((eq & plus) + plus) ^ plus) | eq | minus
        hp, hm = minus | ~(d0 | plus) & full, d0 & plus
        if hp & top:
            score += 1
        elif hm & top:
            score -= 1
        hp, hm = hp << 1 & full, hm << 1 & full
        plus, minus = hm | ~(d0 | hp) & full, d0 & hp
        if score < best:
            best, end = score, j + 1
    return best, end


@lru_cache(maxsize=1)
def _automaton(items: Items, rate: float):
    """Automaton over all pieces; a piece's value lists (item's place, its length, offset, errors)."""
    import ahocorasick

    uses: dict[str, list] = {}
    for i, (_, text) in enumerate(items):
        errors = int(len(text) * rate)
        for at, piece in pieces(text, errors):
            uses.setdefault(piece, []).append((i, len(text), at, errors))
    a = ahocorasick.Automaton()
    for piece, where in uses.items():
        a.add_word(piece, (len(piece), where))
    a.make_automaton()
    return a


def find(text: str | None, items: Items, rate: float = RATE) -> list[tuple[int, int, int, int]]:
    """(item_id, distance, start, end) of each item that the whole text holds: its best match, the first of equal ones."""
    if not text or not items:
        return []
    low = same_length_lower(text)
    best: dict[int, tuple[int, int, int]] = {}
    tried: dict[int, tuple[int, int]] = {}  # per item, its last verified region
    for last, (n_piece, where) in _automaton(items, rate).iter(low):
        for i, n, at, errors in where:
            begin = last + 1 - n_piece - at
            known = best.get(i)
            if known and known[0] == 0:
                continue
            if begin >= 0 and low.startswith(items[i][1], begin):
                best[i] = (0, begin, begin + n)
                continue
            left, right = max(0, begin - errors), min(len(low), begin + n + errors)
            was = tried.get(i)
            if was and was[0] <= left and right <= was[1]:
                continue  # the last region held this one
            right = min(len(low), right + n)  # some more, so that hits side by side are verified once
            tried[i] = left, right
            distance, end = myers(items[i][1], low[left:right])
            if distance <= errors and (known is None or distance < known[0]):
                back, length = myers(items[i][1][::-1], low[left:left + end][::-1])
                best[i] = (distance, left + end - length if back == distance else max(left, left + end - n), left + end)
    return [(items[i][0], *x) for i, x in sorted(best.items())]


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", chars: int = BLOCK_CHARS) -> Iterator[Items]:
    """The items (lower-cased, without null or blank ones), in blocks of bounded size, fetched one after the other."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where(F.trim("text") != "").distinct().orderBy("item_id", "text")
    for block in by_bytes(((r.item_id, same_length_lower(r.text)) for r in rows.toLocalIterator()), lambda x: len(x[1]), chars):
        yield tuple(block)


def hits(items: Items, text: Column, rate: float = RATE) -> Column:
    """Array of the items of a block that a text holds."""

    @F.pandas_udf(HITS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([[dict(zip(("item_id", "distance", "start", "end"), x, strict=True)) for x in find(t, items, rate)] for t in s.tolist()], dtype=object)

    return run(text)


def contamination(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, distance, start, end (characters).

    Null and empty texts hold nothing, null and blank items are in nothing.
    Repeated rows give repeated rows. Row-local: the documents are read once a
    block of items, there is no shuffle and no pair of documents.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for items in item_blocks(benchmark):
        part = rows.select("doc_id", F.explode(hits(items, F.col("text"), rate)).alias("hit")).select("doc_id", "hit.*")
        out = part if out is None else out.unionAll(part)
    return docs.sparkSession.createDataFrame([], out_schema(docs, id_col)) if out is None else out


def out_schema(docs: DataFrame, id_col: str) -> str:
    return f"doc_id {dict(docs.dtypes)[id_col]}, item_id long, distance int, start int, end int"


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text") -> DataFrame:
    """The documents that hold no item, with all their columns."""
    for items in item_blocks(benchmark):
        docs = docs.where(F.size(hits(items, F.col(text_col), rate)) == 0)
    return docs
