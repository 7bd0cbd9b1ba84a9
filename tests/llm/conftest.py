import os
import random

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def words(rng: random.Random, n: int, alphabet: str = "en") -> str:
    syllables = {"en": ["th", "er", "on", "an", "re", "ing"], "de": ["sch", "ung", "ü", "keit", "ein", "ß"]}[alphabet]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


def corpus(seed: int = 1) -> list[tuple]:
    """Plain documents and the awkward ones: null, empty, blank, wordless, copies, near copies, shared passages, a long one, repeated rows."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(1, 200), rng.choice(["en", "de"])) for _ in range(40)]
    passage = words(rng, 70)
    texts: list = [None, "", " \n\t", "!!! %%%", "one", "two words", *base]
    texts += [base[0]] * 5 + [base[1]] * 3
    for b in base[:12]:
        w = b.split(" ")
        if len(w) > 20:
            w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [f"{words(rng, 30)} {passage} {words(rng, 25)}" for _ in range(8)]
    texts += [passage, "aé" * 600, "ab" * 300 + "ab" * 200, words(rng, 6000), "漢字かな交じり文" * 40]
    rows = [(i * 3, t, rng.choice(["en", "de", None]), f"src{i % 4}", len(t) if t else None) for i, t in enumerate(texts)]
    return rows + [rows[10], rows[10]]  # repeated rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The corpus with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("extra") for c in ("row", "own", "h", "k1", "size", "shard", "bucket", "language", "spans", "kept", "n_bytes", "joined", "next", "hit")})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
