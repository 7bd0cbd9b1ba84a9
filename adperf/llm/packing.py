"""Operator 8: packing by the sum-of-squares rule.

Every document's tokens are cut into whole windows and a remainder. A remainder
goes, online, to the fill level that leaves the least sum of squared counts of
partially filled windows (a level array counts them). What is still open when a
partition ends is cut to fill up the fuller windows; the last window is written
as sequences whose lengths are powers of two, so that nothing is padded.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
#: Open windows a task holds; beyond that it closes them (this bounds memory and costs a few more cuts).
MOST_OPEN = 8192
#: Fixed values of the public vocabulary: its pre-tokenizer's pattern and special token.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = {"<|endoftext|>": 50256}
#: The same for texts in which no two white-space characters meet; without a look-ahead it runs faster.
SINGLE_SPACES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
OTHER_SPACE = re.compile(r"[^\S \n]")
#: From this length on, a white-space run is encoded outside the pattern, whose look-ahead stacks an entry for each character (up to 1,000,000).
LONG_RUN = 1 << 16
#: White space as the pattern's \s has it (Python's has four control characters more).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_SPACES = re.compile(f"(?<![{SPACE}])[{SPACE}]{{{LONG_RUN},}}")
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=2)
def _encoders(path: str):
    """Byte-pair encoders of a vocabulary in rank form; they give the ids that its tokenizers file gives."""
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    make = lambda name, pattern: tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return make("any", PATTERN), make("single", SINGLE_SPACES), make("run", r"\s+")


def _ids(text: str, path: str) -> np.ndarray:
    single = not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or OTHER_SPACE.search(text))
    return _encoders(path)[single].encode_to_numpy(text, allowed_special="all")


def token_ids(text: str | None, path: str) -> np.ndarray:
    """Ids of a whole text; special strings inside are special tokens, as the library's default has it.

    A very long white-space run is one piece, as the pattern has it: all of it at the
    end of the text or before a special string, otherwise all but its last character.
    """
    if not text:
        return np.zeros(0, np.uint32)
    parts, start = [], 0
    for run in LONG_SPACES.finditer(text) if len(text) >= LONG_RUN else ():
        end = run.end() if run.end() == len(text) or text.startswith(tuple(SPECIAL), run.end()) else run.end() - 1
        parts += [_ids(text[start:run.start()], path), _encoders(path)[2].encode_to_numpy(text[run.start():end])]
        start = end
    return np.concatenate([*parts, _ids(text[start:], path)]) if parts else _ids(text, path)


class Packer:
    """Packs the documents of one partition; rows of finished sequences are in ``rows``."""

    def __init__(self, first_sequence: int, window: int = WINDOW) -> None:
        self.window, self.next, self.rows = window, first_sequence, []
        self.counts = np.zeros(window + 1, np.int64)  # the level array: open windows by fill
        self.open: dict[int, list[list]] = {}  # level -> open windows, each a list of pieces (doc, start, ids, doc_tokens)
        self.n_open = 0

    def add(self, doc, ids: np.ndarray) -> None:
        n, w = len(ids), self.window
        for start in range(0, n - n % w, w):
            self._finish([(doc, start, ids[start:start + w], n)])
        if rest := n % w:
            self._place((doc, n - rest, ids[n - rest:], n), rest)
        if self.n_open > MOST_OPEN:
            self.close()

    def level(self, size: int) -> int:
        """The fill level (0: a new window) that minimises the sum of squares; the fullest of equal ones."""
        w, c = self.window, self.counts
        levels = np.flatnonzero(c[1:w - size + 1]) + 1
        after = c[levels + size] * 2 + 1
        after[levels + size == w] = 0  # a full window is no longer counted
        change = after - 2 * c[levels] + 1
        fresh = 0 if size == w else 2 * c[size] + 1
        if len(change) and (best := len(change) - 1 - int(np.argmin(change[::-1]))) >= 0 and change[best] <= fresh:
            return int(levels[best])
        return 0

    def _place(self, piece, size: int) -> None:
        h = self.level(size)
        pieces: list = []
        if h:
            pieces = self.open[h].pop()
            self.counts[h] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if h + size == self.window:
            self._finish(pieces)
        else:
            self.open.setdefault(h + size, []).append(pieces)
            self.counts[h + size] += 1
            self.n_open += 1

    def close(self) -> None:
        """Fills the fullest open windows with cut pieces of the emptiest, and splits what is left into powers of two."""
        left = [(h, p) for h in sorted(self.open, reverse=True) for p in self.open[h]]
        self.open, self.n_open = {}, 0
        self.counts[:] = 0
        donor: list = []
        while left or donor:
            if not left:
                left, donor = [(sum(len(p[2]) for p in donor), donor)], []
                break
            fill, pieces = left.pop(0)
            while fill < self.window and (donor or left):
                if not donor:
                    donor = left.pop()[1]
                doc, start, ids, n = donor.pop()
                take = min(len(ids), self.window - fill)
                pieces.append((doc, start, ids[:take], n))
                if take < len(ids):
                    donor.append((doc, start + take, ids[take:], n))
                fill += take
            if fill < self.window:
                left = [(fill, pieces)]
                break
            self._finish(pieces)
        for fill, pieces in left:
            for bit in range(self.window.bit_length() - 1, -1, -1):
                if fill >> bit & 1:
                    pieces = self._split(pieces, 1 << bit)

    def _split(self, pieces: list, size: int) -> list:
        """Finishes a sequence of the first ``size`` ids, and returns the other pieces."""
        first: list = []
        while size:
            doc, start, ids, n = pieces[0]
            take = min(len(ids), size)
            first.append((doc, start, ids[:take], n))
            pieces = [(doc, start + take, ids[take:], n), *pieces[1:]] if take < len(ids) else pieces[1:]
            size -= take
        self._finish(first)
        return pieces

    def _finish(self, pieces: list) -> None:
        at = 0
        for doc, start, ids, n in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, self.next, at))
            at += len(ids)
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * 7
        names = [x.split(" ")[0] for x in SCHEMA.split(", ")]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pack(docs: DataFrame, ranks: str, window: int = WINDOW, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``ranks`` is the path, on every executor, of the vocabulary in rank form. A
    null or empty text has the end id alone; repeated rows are packed each; a null
    id stays null. Each input partition is packed on its own, without a
    shuffle, and a sequence id holds the partition's number, so that a task that
    runs again gives the same rows. A task holds one Arrow batch and a bounded
    number of open windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 40, window)
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                packer.add(doc, np.append(token_ids(text.as_py(), ranks), np.uint32(end_id)))
                if len(packer.rows) >= 10_000:
                    yield packer.batch()
        packer.close()
        yield packer.batch()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
