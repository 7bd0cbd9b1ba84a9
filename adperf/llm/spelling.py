"""Operator 11: spelling variant grouping by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point apart. One
word of a pair, the shorter (of equal lengths, the smaller), contributes two
disjoint chunks, its halves; the other all grams of that length which can lie
within shift one of a chunk: the first half at shift none, the second at shift
none or one. One edit leaves one chunk whole, so near words meet in a bucket, and
Levenshtein distance decides.

A bucket of many words is not joined. In it, all but one part of the words is
known to agree, and the edit lies in that part: its words get chunks of the part,
and so on. A part of one code point bounds a bucket by the alphabet, so no bucket
holds many pairs that are not near, and none is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import ascii_lower, stored

#: Runs of letters: A-Z, a-z and the upper half of Latin-1.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_CHARS, MIN_COUNT = 6, 5
#: A word's form is so many times as frequent at least.
RATIO = 5
#: Buckets of more candidate pairs get finer chunks while a part can be halved. A speed setting: results are the same for any value.
BUCKET_PAIRS = 4096


def _lower(run: Column) -> Column:
    """A-Z in lower case; only ASCII runs, most of them, can take the library's lower()."""
    return F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(ascii_lower(run))


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, word): the lower-cased runs of ``min_chars`` code points or more of each whole text."""
    runs = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    return runs.where(F.char_length("run") >= min_chars).select("doc_id", _lower(F.col("run")).alias("word"))


def misspelt(found: DataFrame, every: int = 199) -> DataFrame:
    """The words with the errors that the query plants: h = crc32 of ``doc_id:word``; where ``every`` divides h, without code point h % length. A null id is written as nothing."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    cut = F.expr("concat(left(word, int(h % char_length(word))), substr(word, int(h % char_length(word)) + 2))")
    return found.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(found: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of words long and frequent enough; counts combine before the shuffle, so a hot word costs a row a task."""
    return found.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _buckets(rows: DataFrame) -> DataFrame:
    """Rows with the bucket of their words, which agree outside the part [a, b) of the chunked word (one place longer in the other, if it is longer)."""
    return rows.withColumn("bucket", F.expr("xxhash64(base, a, b, left(word, a), right(word, base - b))"))


def _halved(rows: DataFrame) -> DataFrame:
    """Two rows for one: the first half of the part is whole, or the second is."""
    half = F.col("a") + F.expr("(b - a) div 2")
    parts = F.array(F.struct(half.alias("a"), F.col("b").alias("b")), F.struct(F.col("a").alias("a"), half.alias("b")))
    return _buckets(rows.select("word", "n", "base", "longer", F.explode(parts).alias("part")).select("word", "n", "base", "longer", "part.a", "part.b"))


def _level(rows: DataFrame, most: int) -> DataFrame:
    """Rows of buckets that hold a candidate pair, and whether the bucket is to be split; a written table."""
    rows = stored(rows, "chunks")
    sizes = rows.groupBy("bucket").agg(F.count_if(~F.col("longer")).alias("x"), F.count_if("longer").alias("y")).withColumn("pairs", F.expr("x * (x - 1) div 2 + x * y"))
    sizes = sizes.where("pairs > 0").select("bucket", (F.col("pairs") > most).alias("hot"))
    return stored(rows.join(sizes, "bucket").withColumn("hot", F.expr("hot and b - a > 1")), "buckets")


def near_pairs(words: DataFrame, most: int = BUCKET_PAIRS) -> DataFrame:
    """(word, n, other, other_n): each pair of near words once. ``words`` (word, n) holds each word once; empty words have no chunks and are left out."""
    size = F.char_length("word")
    roles = F.array(F.struct(size.alias("base"), F.lit(False).alias("longer")), F.struct((size - 1).alias("base"), F.lit(True).alias("longer")))
    rows = _halved(words.where(size > 0).select("word", "n", F.explode(roles).alias("role")).select("word", "n", "role.*", F.lit(0).alias("a"), F.col("role.base").alias("b")).where("base > 0"))
    out = None
    while True:
        level = _level(rows, most)
        cold = level.where("not hot")
        chunked = cold.where("not longer").select("bucket", "word", "n")
        grams = cold.select("bucket", F.col("word").alias("other"), F.col("n").alias("other_n"), "longer")
        pairs = (chunked.join(grams, "bucket").where((F.col("longer") | (F.col("word") < F.col("other"))) & (F.levenshtein("word", "other", 1) == 1))
                 .select("word", "n", "other", "other_n"))
        out = pairs if out is None else out.unionAll(pairs)
        hot = level.where("hot")
        if hot.isEmpty():
            return out.dropDuplicates(["word", "other"])  # an insertion beside an equal letter shows in both halves
        rows = _halved(hot)


def variants(words: DataFrame, ratio: int = RATIO, most: int = BUCKET_PAIRS) -> DataFrame:
    """(word, n, n_near, form, form_n): the near words' number, and the most frequent of them if ``ratio`` times as frequent as the word (ties: the smallest in code-point order)."""
    words = stored(words, "words")
    pairs = stored(near_pairs(words, most), "pairs")
    both = pairs.select("word", "other", "other_n").unionAll(pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best"))
    rows = words.join(best, "word", "left").withColumn("has", F.coalesce(-F.col("best.less") >= ratio * F.col("n"), F.lit(False)))
    return rows.select("word", "n", F.coalesce("near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("has"), F.col("best.other")).alias("form"), F.when(F.col("has"), -F.col("best.less")).alias("form_n"))


def with_roots(found: DataFrame) -> DataFrame:
    """``variants`` with root: the last word of the chain of forms, the word itself if it has none.

    Steps double, and only words whose chain goes on take part, so the words that
    end at one root are never joined to it. Counts grow along a chain by the ratio, so it ends.
    """
    links = found.where("form is not null").select("word", F.col("form").alias("root"))
    steps = stored(links, "steps")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "steps")
        moved = not after.where("moved").isEmpty()
        steps = after.select("word", "root")
        if not moved:
            return found.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, planted: bool = False, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO, most: int = BUCKET_PAIRS,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    Words are the lower-cased (A-Z only) runs of letters of whole texts, of
    ``min_chars`` code points and ``min_count`` occurrences at least. Null, empty
    and letterless texts have no words; repeated rows count each; other columns
    are ignored; an empty table gives no rows. With ``planted`` one word in 199 of
    a document loses a code point first. A chain of forms ends at its root.
    """
    found = occurrences(docs, min_chars, id_col, text_col)
    words = vocabulary(misspelt(found) if planted else found.select("word"), min_chars, min_count)
    return with_roots(stored(variants(words, ratio, most), "variants"))
