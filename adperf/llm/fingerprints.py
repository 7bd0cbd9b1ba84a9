"""Operator 1: document fingerprints by winnowing, DataFrame functions only.

Tokens are runs of up to 16 other characters than white space, and the single
characters of longer runs, so that a passage of a text without spaces has the
same tokens wherever it stands. A gram is GRAM tokens, hashed by a cyclic polynomial, which rolls: the hash of a gram is made
of the hashes of its two halves by a rotation and an exclusive or. Of each
WINDOW grams in a row the one of least hash is kept with its position, the
rightmost of equal ones. Two texts with WINDOW + GRAM - 1 tokens in common, in a
row, share a kept gram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import stored
from adperf.llm.order import cyclic_next

TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{1,16}(?![^\x20\x09-\x0D])|[^\x20\x09-\x0D]"
GRAM, WINDOW = 5, 8
#: Low bits of a key, which hold a gram's position counted backwards; the others hold its hash.
POSITION_BITS = 26
MASK = (1 << POSITION_BITS) - 1


def _rotated(c: Column, by: int) -> Column:
    return F.shiftleft(c, by).bitwiseOR(F.shiftrightunsigned(c, 64 - by))


def _shifted(c: Column, by: int) -> Column:
    """The array without its first ``by`` elements."""
    return F.slice(c, by + 1, F.greatest(F.size(c) - by, F.lit(0)))


def _of(step, size: int):
    return lambda a, b: step(a, b, size)


def _doubled(df: DataFrame, col: str, length: int, step) -> DataFrame:
    """From values of 1, builds those of ``length`` neighbours by doubling: step(left, right, size of right).

    Each pass is a column of its own that is used more than once, so that the
    optimiser keeps the passes apart and each is computed once.
    """
    done, parts = 1, {1: col}
    while done * 2 <= length:
        df = df.withColumn(f"{col}_{done * 2}", F.zip_with(parts[done], _shifted(F.col(parts[done]), done), _of(step, done)))
        done *= 2
        parts[done] = f"{col}_{done}"
    whole, at = parts[done], done
    for size in sorted(parts, reverse=True):
        if at < length and size <= length - at:
            df = df.withColumn(f"{col}_all{at + size}", F.zip_with(whole, _shifted(F.col(parts[size]), at), _of(step, size)))
            whole, at = f"{col}_all{at + size}", at + size
    return df.withColumn(f"{col}_whole", F.col(whole))


def winnow(df: DataFrame, text_col: str, into: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """df with the array ``into`` of keys, ascending in position: hash above POSITION_BITS, MASK minus the position below.

    A null text or one without tokens has none; one of fewer than ``gram`` tokens has one
    gram of all of them, and one of fewer than ``window`` grams one window.
    """
    keep = [c for c in df.columns if c != into]
    t, g = f"__{into}_t", f"__{into}_g"
    df = df.withColumn(t, F.transform(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(TOKEN), F.lit(0)), lambda x: F.xxhash64(x)))
    df = _doubled(df, t, gram, lambda a, b, n: _rotated(a, n).bitwiseXOR(b))
    short = F.array(F.aggregate(t, F.lit(0).cast("long"), lambda a, b: _rotated(a, 1).bitwiseXOR(b)))
    n = F.size(t)
    grams = F.when(n >= gram, F.slice(f"{t}_whole", 1, F.greatest(n - gram + 1, F.lit(0)))).when(n > 0, short).otherwise(F.array().cast("array<long>"))
    df = df.withColumn(g, F.transform(grams, lambda x, i: x.bitwiseAND(F.lit(~MASK)).bitwiseOR(F.lit(MASK) - i)))
    # least() passes over the nulls behind the array's end, so a text of few grams has one window of them all.
    df = _doubled(df, g, window, lambda a, b, n: F.least(a, b))
    return df.withColumn(into, F.array_distinct(F.slice(f"{g}_whole", 1, F.when(F.size(g) == 0, 0).otherwise(F.greatest(F.size(g) - window + 1, F.lit(1)))))).select(*keep, into)


def hashes(keys: Column) -> Column:
    """The set of the hashes of keys, to 32 bits."""
    return F.array_distinct(F.transform(keys, lambda x: F.shiftright(x, 32).cast("int")))


def written(keys: Column) -> Column:
    """A fingerprint as text: hash@position of each kept gram, in order."""
    return F.array_join(F.transform(keys, lambda x: F.concat(F.hex(F.shiftrightunsigned(x, POSITION_BITS)), F.lit("@"), (F.lit(MASK) - x.bitwiseAND(F.lit(MASK))).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes in all hashes of two sets, 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last quarter of the code points (rounded down)
    replaced by as many first ones of the next document in the order of doc_id.
    Null texts count as empty. Of rows with one id the smallest text is the one
    that the previous document borrows from; each row is edited and returned. A
    null id has no next document: an empty one stands for it. Empty input gives no rows.

    Texts are shuffled once, by id; both joins read that exchange. A document
    sends its predecessor what it borrows and the hashes it is compared with.
    """
    # An alias of the same name would stay in one of the two plans only, and their exchanges would differ.
    every = docs.select(F.col(id_col) if id_col == "doc_id" else F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = every.where(F.col("doc_id").isNotNull())  # the same frame, and so the same exchange, for both joins
    ids = stored(rows.groupBy("doc_id").agg(F.max(F.floor(F.char_length("text") / 4)).cast("int").alias("borrows")), "ids")
    links = cyclic_next(ids, "doc_id").select(F.col("next").alias("doc_id"), F.col("doc_id").alias("to"), "borrows")
    lent = rows.join(links, "doc_id")
    sent = (winnow(lent, "text", "keys").select("to", F.expr("substring(text, 1, borrows)").alias("borrowed"), hashes(F.col("keys")).alias("next_hashes"))
            .groupBy("to").agg(F.min(F.struct("borrowed", "next_hashes")).alias("lent")).withColumnRenamed("to", "doc_id"))
    whole = rows.join(sent, "doc_id", "left").unionByName(every.where(F.col("doc_id").isNull()), allowMissingColumns=True).withColumn("n_chars", F.char_length("text").cast("long"))
    edited = whole.withColumn("edited", F.expr("concat(substring(text, 1, int(n_chars - n_chars div 4)), substring(coalesce(lent.borrowed, ''), 1, int(n_chars div 4)))"))
    found = winnow(winnow(edited, "text", "keys"), "edited", "edited_keys")
    found = found.withColumns({"own_hashes": hashes(F.col("keys")), "edited_hashes": hashes(F.col("edited_keys")), "next_hashes": F.coalesce("lent.next_hashes", F.array().cast("array<int>"))})
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), written(F.col("keys")).alias("fingerprint"), written(F.col("edited_keys")).alias("edited_fingerprint"),
        likeness(F.col("own_hashes"), F.col("edited_hashes")).alias("near_edited"), likeness(F.col("own_hashes"), F.col("next_hashes")).alias("near_next"),
    )
