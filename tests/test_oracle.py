"""Spark queries against their DuckDB oracles on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from adperf.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KEYS = ["ad_signal", "ad_signal_attr", "feature_build", "click_bucket", "label_first_n", "site_offer", "bounce_item",
        "attribution", "spend_revenue_report", "gated_override", "eval_table", "variant_cluster", "tfidf_terms",
        "publish_dynamic", "publish_table", "text_lookup", "variant_members", "weighted_price", "signal_dataset", "label_encode"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.6g}")
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.execute(E.oracle_sql()[key])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want


def test_registry_complete():
    q, s = catalog.queries(), catalog.oracle_sql()
    assert len(q) == 111 and set(s) <= set(q)
    assert set(q) - set(s) == {"gbt_oof", "kfold_score", "text_svd", "fm_regression", "text_model_frame", "model_eval_table"}
    assert set(q) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
