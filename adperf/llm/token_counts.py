"""Operator 5: token counts.

Arrow functions return lengths only. A text is cut at white space, which the
tokenizer drops, so the count of a text is the sum over its chunks; chunks seen
before are looked up and the rest go to the tokenizer in batches of equal bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import by_bytes

#: Characters of a long text that are looked at in one go.
PIECE_CHARS = 1 << 20
#: UTF-8 bytes that go to the tokenizer in one call.
BATCH_BYTES = 1 << 16
#: Chunks a worker remembers; beyond that it starts anew (this bounds memory, not results).
REMEMBERED = 1 << 19


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=2)
def _known(path: str) -> dict[str, int]:
    return {}


def pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """Cuts a long text before a space or line break; a run without any stays whole."""
    start = 0
    while len(text) - start > most:
        cut = min((x for x in (text.find(" ", start + most), text.find("\n", start + most)) if x >= 0), default=-1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def _chunks(piece: str) -> list[str]:
    """Chunks between ASCII white space. Without a special string the tokenizer lower-cases ASCII itself, so that is done first."""
    if "<|" not in piece and piece.isascii():
        piece = piece.lower()
    return piece.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def count_batch(texts: list[str | None], path: str) -> list[int]:
    """Tokens of each text. The tokenizer must drop white space and treat it as a boundary (word_bpe_49k.json does)."""
    known = _known(path)
    t = _tokenizer(path)
    out = []
    for text in texts:
        n = 0
        for piece in pieces(text or ""):
            chunks = _chunks(piece)
            counts = list(map(known.get, chunks))
            if None in counts:
                if len(known) > REMEMBERED:
                    known.clear()
                    counts = [None] * len(chunks)
                new = list({c for c, x in zip(chunks, counts, strict=True) if x is None})
                for group in by_bytes(new, lambda c: len(c) + 16, BATCH_BYTES):
                    known.update(zip(group, map(len, t.encode_batch_fast(group, add_special_tokens=False)), strict=True))
                counts = map(known.__getitem__, chunks)
            n += sum(counts)
        out.append(n)
    return out


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is the path of a tokenizers file on every executor. Null and
    empty texts have 0 bytes and 0 tokens; repeated rows are counted each;
    other columns are ignored. Row-local: no shuffle, and a worker holds one
    Arrow batch and a bounded memory of chunks.
    """

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(count_batch(s.tolist(), tokenizer), dtype="int64")

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), n_tokens(text).alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)
