"""Operator 2: language identification by compression.

A classifier is one raw-content zstandard dictionary per language, cut from a
bounded sample of labelled texts. Every whole text is compressed, in blocks,
once with each dictionary; the language whose dictionary gives the fewest bytes
wins, and a narrow margin is a rejection.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sample per language: this many slots, each filled by one labelled document, of which up to SNIPPET characters in a row are kept.
SLOTS = 256
SNIPPET = 512
NO_LETTERS = re.compile(r"[\W\d_]+")
# Number signs such as fractions and circled digits, which \w holds and \d does not, are no letters.
_NUMBER_SIGNS = {c: " " for c in range(sys.maxunicode + 1) if chr(c).isalnum() and not chr(c).isalpha() and not chr(c).isdecimal()}
#: Texts are compressed in blocks of so many bytes, each against the whole dictionary.
BLOCK = 4096
#: zstandard level; matches of three bytes count, since in short texts each byte decides. One setting for texts of every size.
LEVEL, LEAST_MATCH = 13, 3
#: Search depth (a power of two) and the match length that ends a search: deeper or longer costs a sixth more and finds no better languages.
SEARCH, ENOUGH = 2, 4
#: The same for a second look at texts that would be rejected, which are few.
DEEP_SEARCH, DEEP_ENOUGH = 9, 256
#: A text is rejected if the second language needs less than this share of bytes more than the first.
MARGIN = 0.001


def held_out(id_col: str | Column = "doc_id") -> Column:
    """Documents that nothing is learned from: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letters(text: str) -> str:
    """The text in lower case with a space for each run of other characters than letters: layout and shouting say nothing of a language."""
    low = text.lower()
    return NO_LETTERS.sub(" ", low if low.isascii() else low.translate(_NUMBER_SIGNS)).strip()


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", slots: int = SLOTS, snippet: int = SNIPPET) -> dict[str, bytes]:
    """Dictionary bytes by language, from documents that are not held out and have a label and a letter.

    A document falls into a slot by a hash of its text; of the documents of a
    (language, slot) the one with the smallest hash is kept, from a place in its
    text that another hash chooses. The sample is ``slots`` snippets a language whatever the
    input, and partial aggregation makes hot languages cheap. Empty input gives
    no language.
    """
    train = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    text = F.col(text_col)
    places = F.greatest(F.char_length(text) - snippet, F.lit(0)) + 1
    block = text.substr(F.pmod(F.xxhash64(F.lit("place"), text), places).cast("int") + 1, F.lit(snippet))
    rows = (train.select(F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("h"), block.alias("s"))
            .groupBy("lang", F.pmod("h", F.lit(slots)).alias("slot")).agg(F.min(F.struct("h", "s")).alias("x"))
            .select("lang", "slot", "x.s").collect())
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.slot)):
        out.setdefault(r.lang, []).append(r.s)
    return {k: "\n".join(map(letters, v)).encode() for k, v in out.items()}


@lru_cache(maxsize=4)
def _compressors(model: tuple[tuple[str, bytes], ...], search: int = SEARCH, enough: int = ENOUGH):
    import zstandard as z

    def of(content: bytes):
        p = z.ZstdCompressionParameters.from_level(LEVEL, source_size=BLOCK, dict_size=len(content), write_content_size=False, write_dict_id=False,
                                                   strategy=z.STRATEGY_BTLAZY2, min_match=LEAST_MATCH,
                                                   search_log=search, target_length=enough)
        d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=p)
        return z.ZstdCompressor(compression_params=p, dict_data=d)

    return [(lang, of(x)) for lang, x in model]


def blocks(data: bytes, most: int = BLOCK) -> list[bytes]:
    """Whole data in blocks of near equal size."""
    n = max(1, -(-len(data) // most))
    step = -(-len(data) // n)
    return [data[i:i + step] for i in range(0, len(data), step)]


def classify(text: str | None, model: tuple[tuple[str, bytes], ...]) -> tuple[str, float]:
    """(language, score): score is the share of bytes that the second language needs beyond the first, 0 to 1.

    ``und`` and 0.0 for a null text, one without letters, or an empty model;
    equal sizes go to the alphabetically first language with score 0.
    """
    data = letters(text or "").encode("utf-8", "replace")
    if not data or not model:
        return "und", 0.0
    parts = blocks(data)
    lang, score = _closest(parts, _compressors(model))
    return (lang, score) if score >= MARGIN else _closest(parts, _compressors(model, DEEP_SEARCH, DEEP_ENOUGH))


def _closest(parts: list[bytes], compressors: list) -> tuple[str, float]:
    sizes = sorted((sum(len(c.compress(p)) for p in parts), lang) for lang, c in compressors)
    if len(sizes) == 1:
        return sizes[0][1], 1.0
    return sizes[0][1], (sizes[1][0] - sizes[0][0]) / max(1, sizes[1][0])


def predict(docs: DataFrame, model: dict[str, bytes], text_col: str = "text", margin: float = MARGIN, into: str = "language") -> DataFrame:
    """All columns of docs and a struct ``into`` (lang_pred, score, rejected).

    ``rejected`` marks ``und`` and margins under ``margin``. Only the text is
    an input. Row-local: no shuffle; the model is as bounded as its sample.
    """
    model_items = tuple(sorted(model.items()))

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            found = [classify(t, model_items) for t in s.tolist()]
            yield pd.DataFrame({"lang_pred": [x for x, _ in found], "score": [float(x) for _, x in found], "rejected": [x == "und" or y < margin for x, y in found]})

    return docs.withColumn(into, identify(F.col(text_col)))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", margin: float = MARGIN) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected. Fits on docs first (a bounded sample)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    found = predict(rows.select("doc_id", "text"), fit(rows), margin=margin)
    return found.select("doc_id", held_out().alias("held_out"), "language.*")
