"""Operator 10: URL filter.

Ordered host and path rules decide first; the rest is judged by gradient-boosted
trees on lexical features, trained on URLs that the rules label.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import stored

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with its path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: URLs the trees are trained on: of each rule's URLs, one for each of so many hash slots at most.
TRAIN_SLOTS = 2000
FEATURES = ["n_url", "n_host", "n_path", "depth", "labels", "digits", "entropy", "params", "dashes", "secure", "suffix_share", "suffix_digits", "suffix_length"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: then up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null fields if none does. Of equally long ones the first wins."""
    found = None
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    return none if found is None else found.otherwise(none)


def _entropy(text: Column) -> Column:
    """Shannon entropy, in bits a character, of the letters a-z, digits and the rest (one class) of a short text."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    seen = F.length(text) - F.length(F.translate(text, "abcdefghijklmnopqrstuvwxyz0123456789", ""))
    total = F.lit(0.0)
    for c in "abcdefghijklmnopqrstuvwxyz0123456789":
        p = (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))) / n
        total = total + F.when(p > 0, -p * F.log2(p)).otherwise(0.0)
    p = (F.length(text) - seen) / n
    return total + F.when(p > 0, -p * F.log2(p)).otherwise(0.0)


def suffix(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def with_features(urls: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Lexical features of (url, host, path), and the statistics of the host's suffix."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    count = lambda c, x: F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))
    query = F.when(F.instr(url, "?") > 0, F.substring_index(F.substring_index(url, "?", -1), "#", 1)).otherwise(F.lit(""))
    rows = urls.withColumns({
        "suffix": suffix(F.col("host")), "n_url": F.length(url), "n_host": F.length("host"), "n_path": F.length("path"),
        "depth": count(F.col("path"), "/"), "labels": F.when(F.col("host") == "", 0).otherwise(count(F.col("host"), ".") + 1),
        "digits": (n - F.length(F.translate(url, "0123456789", ""))) / n, "entropy": _entropy(F.lower(F.concat("host", "path"))),
        "params": F.when(query == "", 0).otherwise(count(query, "&") + 1), "dashes": count(url, "-"), "secure": url.startswith("https:").cast("int"),
    })
    rows = rows.join(suffixes, "suffix", "left").fillna(0.0, ["suffix_share", "suffix_digits", "suffix_length"])
    return rows.withColumns({c: F.col(c).cast("double") for c in FEATURES})


def suffix_statistics(urls: DataFrame) -> DataFrame:
    """Per suffix, over all URLs: share of the URLs (log scale), mean share of digits, mean length. No label is used."""
    n = F.greatest(F.length("url"), F.lit(1))
    return (urls.groupBy(suffix(F.col("host")).alias("suffix"))
            .agg(F.log1p(F.count("*")).alias("suffix_share"), F.coalesce(F.avg((n - F.length(F.translate("url", "0123456789", ""))) / n), F.lit(0.0)).alias("suffix_digits"), F.coalesce(F.avg(F.length("url")), F.lit(0.0)).alias("suffix_length")))


def training_sample(labelled: DataFrame, slots: int = TRAIN_SLOTS) -> DataFrame:
    """Of each rule's URLs the one of smallest hash in each of ``slots`` slots: bounded whatever the input, and alike in every run."""
    h = F.xxhash64("url")
    return (labelled.groupBy("rule", F.pmod(h, F.lit(slots)).alias("slot")).agg(F.min(F.struct(h.alias("h"), *labelled.columns)).alias("x"))
            .select("x.*").drop("h"))


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", slots: int = TRAIN_SLOTS, trees: int = 20, depth: int = 4) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, blocked_score.

    A null URL or one without ``://`` has an empty host and path; repeated rows
    are judged alike. Trees are trained on ``slots`` URLs a rule at most. If the
    rules label one class only, or nothing, the method's verdict is that class,
    or allow. Other columns of pages are ignored.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = with_features(urls, suffix_statistics(urls)).withColumn("by_rule", rule_of(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", "url", "by_rule.*", *FEATURES)
    labelled = training_sample(rows.where(F.col("rule").isNotNull()).select("rule", "url", (F.col("verdict") == "block").cast("double").alias("label"), *FEATURES), slots)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    train = assembler.transform(stored(labelled, "urls").repartition(4)).select("label", "features")
    classes = [r[0] for r in train.select("label").distinct().collect()]
    if len(classes) == 2:
        model = GBTClassifier(labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, maxBins=32, seed=0).fit(train)
        scored = model.transform(assembler.transform(rows)).withColumn("blocked_score", vector_to_array("probability")[1])
    else:
        scored = rows.withColumn("blocked_score", F.lit(classes[0] if classes else 0.0))
    judged = F.coalesce("verdict", F.when(F.col("blocked_score") > 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", judged.alias("verdict"), "blocked_score")
