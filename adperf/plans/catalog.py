"""All registered queries and their oracle SQL."""

from __future__ import annotations

from adperf.plans import q_attr, q_clicks, q_eval, q_merge, q_model, q_publish, q_report, q_signals

MODULES = [q_signals, q_clicks, q_eval, q_attr, q_report, q_publish, q_model, q_merge]


def queries() -> dict:
    out = {}
    for m in MODULES:
        out.update(m.Q)
    return out


def oracle_sql() -> dict:
    out = {}
    for m in MODULES:
        out.update(m.SQL)
    return out
