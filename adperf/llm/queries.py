"""Registered queries of the training-data operators."""

from __future__ import annotations

import os
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from adperf.llm import bpe_automaton as _automaton
from adperf.llm import decontaminate as _benchmark
from adperf.llm import fingerprints as _fingerprints
from adperf.llm import language_id as _language
from adperf.llm import license_scan as _license
from adperf.llm import near_dedup as _near
from adperf.llm import packing as _packing
from adperf.llm import periodic_runs as _runs
from adperf.llm import sharding as _sharding
from adperf.llm import spelling as _spelling
from adperf.llm import substring_dedup as _substrings
from adperf.llm import token_counts as _tokens
from adperf.llm import url_filter as _urls
from adperf.llm.common import table


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; the same on driver and executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _language.language_id(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _substrings.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _benchmark.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokens.token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _license.license_scan(table(spark, sf_dir, "documents")).drop("detections")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near.near_duplicates(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sharding.shards(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls.url_filter(table(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spelling.spelling_variants(table(spark, sf_dir, "documents"), planted=True)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs.digests(_runs.periodic_runs(_runs.looped(table(spark, sf_dir, "documents"))))


def op13_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _automaton.digests(_automaton.encode_decode(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")))


def _importable(query):
    """Python workers of a local session find this package even if Python was not started in its folder.

    On a cluster the package is installed or sent with the job (``--py-files``).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.sparkContext.master.startswith("local[") and root not in os.environ.get("PYTHONPATH", "").split(":"):
            spark.sparkContext.environment.setdefault("PYTHONPATH", root)
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    return {f.__name__: _importable(f) for f in (op1_fingerprints, op2_language_id, op3_substring_dedup, op4_decontaminate, op5_token_counts, op6_license_scan, op7_near_dedup, op8_packing, op9_sharding, op10_url_filter, op11_spelling_variants, op12_periodic_runs, op13_bpe_automaton)}


def oracle_sql() -> dict[str, str]:
    return {}
