"""Operator 3: exact substring removal with suffix arrays.

Every LENGTH-byte string is dealt to a task by its minimizer: the GRAM-byte string
in it of least hash (the rightmost of equal ones). Strings side by side with one
minimizer travel together, as a segment. A minimizer that occurs once shows that
its segment's strings are unique, so only segments of repeated minimizers travel
at all. Each task sorts the suffixes of its segments in two stages and finds
repeated strings by the common prefixes of neighbours.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import stored
from adperf.llm.shingles import chunks, mixed, text_bytes
from adperf.llm.suffix_array import repeated

LENGTH = 200
GRAM = 40
#: Bytes of segments in one suffix array.
ARRAY_BYTES = 1 << 22
#: Minimizers with more different segments than this are dealt to tasks by single strings.
MOST_SEGMENTS = 1 << 14

_BYTE = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POSITION_BITS = 24


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place on (where they end inside), built by doubling."""
    done, out, parts = 1, _BYTE[data], {}
    parts[1] = out
    while done * 2 <= gram:
        out = out[:-done] * np.uint64(pow(_BASE, done, 1 << 64)) + out[done:]
        done *= 2
        parts[done] = out
    for size in sorted(parts, reverse=True):
        while done + size <= gram:
            right = parts[size][done:]
            out = out[:len(right)] * np.uint64(pow(_BASE, size, 1 << 64)) + right[:len(out)]
            done += size
    return mixed(out)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def minimizers(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Segments of several texts: (text number, first place, number of strings, minimizer's hash), places within their text.

    Works through pieces that overlap by a string, so that memory is bounded for a text of any length.
    """
    texts, firsts, counts, hashes = [], [], [], []
    piece = (1 << _POSITION_BITS) - length
    for t0, t1 in chunks(offsets, 1 << 20):
        if offsets[t1] - offsets[t0] < length:
            continue
        for begin in range(int(offsets[t0]), int(offsets[t1]) - length + 1, piece):
            part = data[begin:min(begin + piece + length - 1, int(offsets[t1]))]
            h = gram_hashes(part, gram)
            low = np.uint64((1 << _POSITION_BITS) - 1)
            key = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
            where = (low - (_sliding_least(key, length - gram + 1) & low)).astype(np.int64)  # the minimizer of each string
            text = np.searchsorted(offsets, begin + np.arange(len(where)), "right") - 1
            whole = begin + np.arange(len(where)) + length <= offsets[text + 1]
            new = np.ones(len(where), bool)
            new[1:] = (where[1:] != where[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
            starts = np.flatnonzero(new & whole)
            if not len(starts):
                continue
            # Strings of a segment stand side by side: it ends at the next segment or where strings leave the text.
            breaks = np.flatnonzero(new | ~whole)
            breaks = np.append(breaks, len(where))
            n = breaks[np.searchsorted(breaks, starts, "right")] - starts
            texts.append(text[starts])
            firsts.append(begin + starts - offsets[text[starts]])
            counts.append(n)
            hashes.append(h[where[starts]])
    if not texts:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in (texts, firsts, counts, hashes))


def _digest(part: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little", signed=True)


def _find_minimizers(length: int, gram: int):
    """Rows (row, text) to segments: minimizer, digest, row, and place (first byte and number of strings in one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_bytes(b.column(1))
            text, first, n, h = minimizers(data, offsets, length, gram)
            whole, begin = memoryview(data), offsets[text] + first
            ids = [_digest(whole[x:y]) for x, y in zip(begin.tolist(), (begin + n + length - 1).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids, pa.int64()), b.column(0).take(pa.array(text)), pa.array(first << 16 | n)], names=["h", "segment", "row", "place"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstandard frames: they travel smaller."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    for b in batches:
        data, offsets = text_bytes(b.column("text"))
        whole = memoryview(data)
        frames = pa.array([pack(whole[x:y]) for x, y in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)], pa.binary())
        yield pa.RecordBatch.from_arrays([*(b.column(k) for k in b.schema.names if k != "text"), frames], names=[*(k for k in b.schema.names if k != "text"), "text"])


def _unpacked(column: pa.Array) -> Iterator[bytes]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return map(unpack, column.to_pylist())


def _part(text: bytes, segment: int, place: int, length: int) -> bytes | None:
    """A segment's bytes; None if they are not at that place, which then is of another row with the same id."""
    first = place >> 16
    part = text[first:first + (place & 0xFFFF) + length - 1]
    return part if _digest(part) == segment else None


def _cut(length: int):
    """Rows (row, text, places of segments) to the segments' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, marks in zip(_unpacked(b.column("text")), b.column("marks").to_pylist(), strict=True):
                for m in marks:
                    if (part := _part(text, m["segment"], m["place"], length)) is not None:
                        rows.append((m["h"], m["segment"], m["place"] & 0xFFFF, part))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["h", "segment", "n", "bytes"])

    return run


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of runs of consecutive ascending numbers."""
    cut = np.flatnonzero(np.diff(places) != 1) + 1
    return places[np.concatenate(([0], cut))], places[np.concatenate((cut - 1, [len(places) - 1]))] + 1


def _sort_segments(length: int):
    """Rows (h, segment, n, bytes) sorted by h: the runs of repeated strings in each segment."""

    def solve(h: list, ids: list, counts: list, parts: list) -> pa.RecordBatch:
        sizes = np.array([len(p) for p in parts], np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        data = np.frombuffer(b"".join(parts), np.uint8)
        n = np.array(counts, np.int64)
        wanted = np.repeat(begins - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        found = repeated(data, wanted, length)
        if not len(found):
            return pa.RecordBatch.from_pylist([], schema=SPANS)
        of = np.searchsorted(ends, found, "right")
        # One number a string, with a gap between segments, so that runs do not join.
        first, end = _runs(found + of)
        of = np.searchsorted(ends + np.arange(len(ends)), first, "right")
        a = first - of - begins[of]
        return pa.RecordBatch.from_arrays([pa.array(np.array(h, np.int64)[of]), pa.array(np.array(ids, np.int64)[of]), pa.array(a.astype(np.int32)), pa.array((a + end - first).astype(np.int32))], schema=SPANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, ids, counts, parts, total = [], [], [], [], 0
        for b in batches:
            for x in zip(*(b.column(k).to_pylist() for k in ("h", "segment", "n", "bytes")), strict=True):
                if total >= ARRAY_BYTES and x[0] != h[-1]:
                    yield solve(h, ids, counts, parts)
                    h, ids, counts, parts, total = [], [], [], [], 0
                for to, v in zip((h, ids, counts, parts), x, strict=True):
                    to.append(v)
                total += len(x[3])
        if h:
            yield solve(h, ids, counts, parts)

    return run


SPANS = pa.schema([("h", pa.int64()), ("segment", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])


def _remove(length: int, keep_text: bool):
    """Rows (row, text, spans: runs of repeated strings of its segments) to what is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, removed, n_spans, shas, texts = [], [], [], [], []
            for text, spans in zip(_unpacked(b.column("text")), b.column("spans").to_pylist(), strict=True):
                here: dict[tuple[int, int], bool] = {}
                runs = []
                for x in spans or ():
                    run, first = x["run"], x["run"] >> 24
                    key = x["segment"], first << 16 | run >> 16 & 255
                    if key not in here:
                        here[key] = _part(text, *key, length) is not None
                    if here[key]:
                        runs.append((first + (run >> 8 & 255), first + (run & 255) + length - 1))
                kept, at, n, gone, last = [], 0, 0, 0, -1
                for begin, end in sorted(runs):
                    if begin > last:
                        n += 1
                        kept.append(text[at:begin])
                        gone += end - begin
                        last = at = end
                    elif end > last:
                        gone += end - last
                        last = at = end
                kept.append(text[at:])
                rest = b"".join(kept)
                sizes.append(len(text))
                removed.append(gone)
                n_spans.append(n)
                shas.append(hashlib.sha256(rest).hexdigest())
                texts.append(rest.decode("utf-8", "ignore") if keep_text else None)
            others = [k for k in b.schema.names if k not in ("row", "text", "spans")]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in others), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())], names=[*others, *(x.split(" ")[0] for x in OUT.split(", "))])

    return run


OUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, most_segments: int = MOST_SEGMENTS, keep_text: bool = False) -> DataFrame:
    """Columns of docs but the text, and n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining text, with keep_text).

    Each byte in a ``length``-byte string that starts anywhere else too, in any
    document or the same one, is removed; strings are judged on the input. Null and empty texts
    and those shorter than ``length`` stay as they are. Each repeated row
    counts as a document of its own, with or without an id. ``kept`` leaves out bytes of characters that were cut
    through. Columns of docs that are named like those of the result, or row, marks or spans, are dropped.

    Texts are shuffled once, by id and compressed, and that exchange is read
    twice: for the bytes of the segments that are sorted and for the removal. Until
    then segments are digests. Equal segments are one row before they are sorted, and
    a segment alone with its minimizer needs no sorting; a minimizer that
    very many different segments share is dealt on by single strings, so that no
    task gets an unbounded group.
    """
    if not gram <= length < gram + 255:
        raise ValueError("a string must hold 1 to 255 places for its minimizer")
    clash = [c for c in docs.columns if c in ("row", "marks", "spans", *(x.split(" ")[0] for x in OUT.split(", "))) and c not in (id_col, text_col)]
    docs = docs.drop(*clash)
    others = [c for c in docs.columns if c != text_col]
    row = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.lit("no id"), F.col(text_col))).alias("row")  # rows without an id are not one group
    rows = docs.select(*others, row, F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    marks = rows.where(F.octet_length("text") >= length).select("row", "text").mapInArrow(_find_minimizers(length, gram), "h long, segment long, row long, place long")
    often = stored(marks.groupBy("h").count().where("count > 1").select("h"), "often")  # a table, so that a skewed join can be split
    found = stored(marks.join(often, "h"), "segments")
    distinct = found.groupBy("h", "segment").agg(F.count("*").alias("copies"), F.min(F.struct("row", "place")).alias("first"))
    distinct = stored(distinct.join(distinct.groupBy("h").agg(F.count("*").alias("segments")), "h"), "distinct")

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*others).schema)
    texts = rows.mapInArrow(_packed, f"{fields}row long, text binary").where("row is not null")  # one exchange for both joins below
    wanted = _by_row(distinct.where("segments > 1").select(F.col("first.row").alias("row"), "h", "segment", F.col("first.place").alias("place")), "marks")
    cut = texts.join(wanted, "row").mapInArrow(_cut(length), "h long, segment long, n int, bytes binary")
    crowds = distinct.where(F.col("segments") > most_segments).select("h").distinct()
    sorted_here = cut.join(crowds, "h", "left_anti").repartition("h").sortWithinPartitions("h").mapInArrow(_sort_segments(length), "h long, segment long, a int, b int")
    copied = distinct.where("copies > 1").select("h", "segment", F.lit(0).alias("a"), F.col("first.place").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("b"))
    spans = copied.unionAll(sorted_here).unionAll(_by_string(cut.join(crowds, "h", "left_semi"), length))
    # First byte, number of strings, first and end of the run of repeated ones, in one number.
    run = F.shiftleft(F.shiftright("place", 16), 24).bitwiseOR(F.shiftleft(F.col("place").bitwiseAND(F.lit(255)), 16)).bitwiseOR(F.shiftleft(F.col("a").cast("long"), 8)).bitwiseOR(F.col("b").cast("long"))
    by_row = _by_row(found.join(spans, ["h", "segment"]).select("row", "segment", run.alias("run")), "spans")
    return texts.join(by_row, "row", "left").mapInArrow(_remove(length, keep_text), fields + OUT)


def _by_row(df: DataFrame, into: str) -> DataFrame:
    """A row's other columns in a list. They travel as plain rows: lists of one before the shuffle would be larger."""
    return df.repartition("row").groupBy("row").agg(F.collect_list(F.struct(*[c for c in df.columns if c != "row"])).alias(into))


def _by_string(segments: DataFrame, length: int) -> DataFrame:
    """The same for segments of crowded minimizers: strings are grouped by two hashes, wherever they are."""
    string = F.substring("bytes", F.col("a") + 1, F.lit(length))
    each = segments.select("h", "segment", "bytes", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("a")).select("h", "segment", "a", F.xxhash64(string).alias("k1"), F.xxhash64(F.lit(1), string).alias("k2"))
    twice = each.groupBy("h", "k1", "k2").count().where("count > 1").drop("count")
    return each.join(twice, ["h", "k1", "k2"]).select("h", "segment", "a", (F.col("a") + 1).alias("b"))
