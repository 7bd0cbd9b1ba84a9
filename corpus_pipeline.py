"""A corpus pipeline over ``documents``: each stage reads what its predecessor kept, as Parquet in the shared folder.

Stages take (spark, docs, sf_dir). All but the last return the columns of
``documents``; other columns of docs are left out. Null and empty texts have no
language and go in the first stage; empty tables stay empty throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adperf.llm import decontaminate, language_id, near_dedup, packing, substring_dedup
from adperf.llm.common import stored, table
from adperf.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those whose two best languages compress alike (the classifier learns from docs)."""
    found = language_id.predict(docs.select(COLUMNS), language_id.fit(docs))
    return found.where(~F.col("language.rejected")).select(COLUMNS)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near-duplicates; rows without an id stay."""
    others = near_dedup.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.select(COLUMNS).join(others, "doc_id", "left_anti").select(COLUMNS)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 200 bytes that stand elsewhere too out of the texts; n_chars follows. Documents stay, if need be without text."""
    found = substring_dedup.substring_dedup(docs.select(COLUMNS), keep_text=True)
    return found.withColumn("text", F.col("kept")).withColumn("n_chars", F.char_length("kept").cast("long")).select(COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of ``benchmark`` within its error budget."""
    return decontaminate.drop_contaminated(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences: one row per piece."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language", keep_known_language),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("repeated_strings", cut_repeated_strings),
    ("benchmark", drop_contaminated),
    ("packing", pack),
]

#: No stage's method (a fitted classifier, suffix arrays, edit distances, online packing) can be said in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
