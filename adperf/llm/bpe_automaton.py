"""Operator 13: BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens. It starts as one state with a loop for each base
symbol, so it accepts every sequence. Each merge (u, v) -> w, in order, applies
one gadget: arcs labelled u are redirected to a copy of their target without its
v arc, so u and v no longer stand side by side, and each state with a u arc gets
a w arc to where v led. At the end exactly the tokenizations are accepted, and
each text has one path.

All arcs of one label lead to one state, so the gadget is one row of a table: the
copy (numbered like the merge) keeps whose arc it serves and what it lost, and
an arc made later is there if that of its left half was there then. Words are
encoded by following the one path; decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import by_bytes

#: Characters of texts that are encoded in one go (a longer text goes alone); bounds memory, not results.
BATCH_CHARS = 1 << 21
#: White-space chunks, and words, that a worker remembers; beyond that it starts anew (this bounds memory, not results).
REMEMBERED = 1 << 19


class Automaton:
    """Tables of the tokenization automaton of a merge list.

    State 0 is the first one; state m is the copy that merge m made. ``target``
    gives the state an arc leads to. Merges must be in an order in which both
    halves are made before they are merged.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        size = max(vocab.values(), default=-1) + 1
        self.size, self.suffix = size, suffix
        self.target = [0] * size
        self.made = [0] * size  # the merge that made a token, 0 for base symbols
        self.left = [-1] * size
        self.owner = [-1]  # per state: its arcs' label
        self.origin = [0] * size  # per token: the state its arcs led to when it was made
        self.merge: dict[int, int] = {}
        alive = [True] * size
        unmade = {vocab[first + second] for first, second in merges}
        for m, (first, second) in enumerate(merges, 1):
            u, v, w = vocab[first], vocab[second], vocab[first + second]
            if u in unmade or v in unmade or w not in unmade:
                raise ValueError("a merge comes before its halves, or twice")
            unmade.remove(w)
            self.made[w], self.left[w] = m, u
            self.owner.append(u)
            if not (alive[u] and alive[v] and self.follows(self.target[u], v)):
                alive[w] = False  # the halves never stand side by side at this point
                continue
            self.merge[u * size + v] = m
            self.target[w] = self.origin[w] = self.target[v]
            self.target[u] = m
        self.tree: dict = {}
        for text, t in vocab.items():
            if alive[t]:
                last = bool(suffix) and text.endswith(suffix) and len(text) > len(suffix)
                node = self.tree
                for c in text.removesuffix(suffix) if last else text:
                    node = node.setdefault(c, {})
                node[1 if last else 0] = t

    def follows(self, state: int, token: int) -> bool:
        """Whether ``state`` has an arc of ``token``."""
        made, left, merge, size = self.made, self.left, self.merge, self.size
        while state:
            u = self.owner[state]
            while made[token] >= state:
                token = left[token]  # a later arc stands for that of its left half
            upto, row = state, u * size
            while True:  # copies of u's target, from this one back to the first
                lost = merge.get(row + token)
                if lost is not None and lost <= upto:
                    return False
                if made[token] <= made[u]:
                    break
                upto, token = made[token], left[token]
            state = self.origin[u]
        return True

    def arcs(self, word: str, at: int) -> list[tuple[int, int]]:
        """(token, where it ends) of the tokens that stand in the word from ``at``, the longest last."""
        n, node, out = len(word), self.tree, []
        for j in range(at, n):
            node = node.get(word[j])
            if node is None:
                break
            token = node.get(1 if self.suffix and j == n - 1 else 0)
            if token is not None:
                out.append((token, j + 1))
        return out

    def encode(self, word: str) -> list[int]:
        """Tokens of a word, whose last symbol carries the suffix: the accepted path, longest arcs first.

        A beginning of the word has one path, so a place that leads nowhere is tried
        once. ValueError for a character that no token holds.
        """
        n, place, state = len(word), 0, 0
        path: list[int] = []
        steps: list[tuple[int, int, list]] = []
        nowhere = set()
        ahead = self.arcs(word, 0)
        while place < n:
            while ahead:
                token, end = ahead.pop()
                if end not in nowhere and self.follows(state, token):
                    steps.append((place, state, ahead))
                    path.append(token)
                    place, state = end, self.target[token]
                    ahead = self.arcs(word, place)
                    break
            else:
                if not steps:
                    raise ValueError("no token for a character")
                nowhere.add(place)
                place, state, ahead = steps.pop()
                path.pop()
        return path


#: The pattern of word_bpe_49k.json, and what it finds in printed ASCII; anything else is split by the library.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[!-/:-@\[-`{-~]+")
PRINTED = re.compile(r"[!-~]+")


class Codec:
    """A word-level BPE file: its own normalizer and pre-splitter, and the automaton for its merges."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        kinds = [x["type"] for x in file["pre_tokenizer"]["pretokenizers"]] if file["pre_tokenizer"] else []
        if model["type"] != "BPE" or model["dropout"] or model["continuing_subword_prefix"] or kinds != ["Split", "ByteLevel"]:
            raise ValueError("only BPE files with a split into words and bytes as symbols")
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        lowers = [x["type"] for x in (file["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self.ascii = lowers and file["pre_tokenizer"]["pretokenizers"][0].get("pattern") == {"Regex": WORD_PATTERN}
        merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.added = {x["content"]: x["id"] for x in file["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, tuple[int, ...]] = {}
        self.chunks: dict[str, int] = {}
        self.flat, self.ends = array("i"), array("q", [0])

    def word(self, word: str) -> tuple[int, ...]:
        got = self.words.get(word)
        if got is None:
            got = self.words[word] = tuple(self.automaton.encode(word))
        return got

    def plain(self, text: str) -> list[int]:
        """Ids of a text without special strings."""
        out: list[int] = []
        if self.ascii and PRINTED.fullmatch(text):
            for word in ASCII_WORD.findall(text.lower()):
                out += self.word(word)
            return out
        for word, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text) if self.normalizer else text):
            out += self.word(word)
        return out

    def chunk(self, text: str) -> list[int]:
        """Ids of a text without white space around it; special strings are found before anything else, as in the library."""
        if self.special is None or "<" not in text:
            return self.plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self.plain(text[at:m.start()]) + [self.added[m[0]]]
            at = m.end()
        return out + self.plain(text[at:])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets). No token of these files spans white space, so texts are cut there and chunks looked up."""
        if len(self.chunks) > REMEMBERED or len(self.words) > REMEMBERED:
            self.forget()
        numbers: list[int] = []
        counts = []
        known = self.chunks
        for text in texts:
            parts = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            found = list(map(known.get, parts))
            if None in found:
                for i, x in enumerate(found):
                    if x is None:
                        n = known.get(parts[i])
                        if n is None:
                            n = known[parts[i]] = len(known)
                            self.flat.extend(self.chunk(parts[i]))
                            self.ends.append(len(self.flat))
                        found[i] = n
            numbers += found
            counts.append(len(found))
        at = np.array(numbers, np.int64)
        ends = np.frombuffer(self.ends, np.int64)
        sizes = ends[at + 1] - ends[at]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        places = np.arange(upto[-1]) - np.repeat(upto[:-1] - ends[at], sizes)
        return np.frombuffer(self.flat, np.int32)[places], upto[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


@lru_cache(maxsize=2)
def labels(path: str) -> pa.Array:
    """Labels of the arcs, by id: all that decoding needs."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    by_id = {t: x for x, t in file["model"]["vocab"].items()} | {x["id"]: x["content"] for x in file["added_tokens"]}
    return pa.array([by_id.get(i) for i in range(max(by_id) + 1)], pa.large_string())


def _decoded(ids: pa.Array, path: str) -> pa.Array:
    ids = pc.fill_null(ids, pa.scalar([], ids.type))
    offsets = ids.offsets.to_numpy()
    emitted = labels(path).take(ids.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])))
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array((offsets - offsets[0]).astype(np.int64)), emitted), pa.scalar(" ", pa.large_string())).cast(pa.string())


def decode(ids: Column, tokenizer: str) -> Column:
    """string: labels of ids joined by single spaces, which is what the library gives for a file without a decoder. Null ids decode to an empty text."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for x in batches:
            yield _decoded(x, tokenizer)

    return run(ids)


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids array<int>, decoded string.

    ``tokenizer`` is the path of a word-level BPE file on every executor. Null and
    empty texts have no ids and decode to an empty text; a null id stays null,
    repeated rows are encoded each, other columns are ignored, and an empty table
    gives no rows. Very long texts and words are encoded whole, in time and memory
    in proportion to their length. Row-local: no shuffle; results leave a task in
    small batches.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in by_bytes(batch.column(1).to_pylist(), len, BATCH_CHARS):
                ids, offsets = codec(tokenizer).encode(group)
                found = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(group)), found, _decoded(found, tokenizer)], ["doc_id", "ids", "decoded"])
                at += len(group)

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>, decoded string")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what ``encode_decode`` gives."""
    written = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(written.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
