"""Metric-pack spec (op B1): per-day averages and null-safe ratios.

Each metric is ``numerator / denominator`` where the numerator is a signed sum
of summed base measures and the denominator is either another base measure or
the window's day count. The same spec renders to Spark columns and, for the
oracle, to SQL text, so the two can never drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS = "__days__"


@dataclass(frozen=True)
class Metric:
    name: str
    numerator: tuple[tuple[str, int], ...]
    denominator: str  # base measure name or DAYS


def _m(name: str, num: str | tuple[tuple[str, int], ...], den: str) -> Metric:
    if isinstance(num, str):
        num = ((num, 1),)
    return Metric(name, num, den)


def metric_spec(targets: tuple[str, ...] | None = ("brand", "seller")) -> list[Metric]:
    """Metric list for attributed targets (brand, seller) or one plain target.

    ``targets=None`` gives the single-target pack over ``orders`` and ``gmv``.
    """
    sfx = [f"_{t}" for t in targets] if targets else [""]
    out: list[Metric] = [_m(b, b, DAYS) for b in ("impressions", "clicks", "adspend", "qty")]
    out += [_m(f"orders{s}", f"orders{s}", DAYS) for s in sfx]
    out += [_m(f"gmv{s}", f"gmv{s}", DAYS) for s in sfx]
    out.append(_m("cost", "cost", DAYS))
    out += [_m(f"margin{s}", ((f"gmv{s}", 1), ("cost", -1)), DAYS) for s in sfx]
    out.append(_m("estimated_cp", "estimated_cp", DAYS))
    out.append(_m("ctr", "clicks", "impressions"))
    out.append(_m("cpc", "adspend", "clicks"))
    for s in sfx:
        margin = ((f"gmv{s}", 1), ("cost", -1))
        out += [
            _m(f"rpc{s}", f"gmv{s}", "clicks"),
            _m(f"roas{s}", f"gmv{s}", "adspend"),
            _m(f"convrt{s}", f"orders{s}", "clicks"),
            _m(f"ordersize{s}", f"gmv{s}", f"orders{s}"),
            _m(f"cpsize{s}", "estimated_cp", f"orders{s}"),
            _m(f"mpc{s}", margin, "clicks"),
            _m(f"mpo{s}", margin, f"orders{s}"),
            _m(f"rpcp{s}", f"gmv{s}", "estimated_cp"),
        ]
    return out


def base_measures(targets: tuple[str, ...] | None = ("brand", "seller")) -> list[str]:
    sfx = [f"_{t}" for t in targets] if targets else [""]
    return (["impressions", "clicks", "adspend", "qty"] + [f"orders{s}" for s in sfx]
            + [f"gmv{s}" for s in sfx] + ["cost", "estimated_cp"])


def _num_col(num: tuple[tuple[str, int], ...], base: dict[str, Column]) -> Column:
    expr = None
    for name, sign in num:
        term = base[name] if sign > 0 else -base[name]
        expr = term if expr is None else expr + term
    return expr


def metric_columns(spec: list[Metric], base: dict[str, Column], days: Column | int | None,
                   prefix: str = "", suffix: str = "") -> list[Column]:
    """Render the spec: ``base`` maps measure names to summed columns."""
    days_col = F.lit(days) if isinstance(days, int) else days
    cols = []
    for m in spec:
        den = days_col if m.denominator == DAYS else base[m.denominator]
        cols.append(F.try_divide(_num_col(m.numerator, base), den).alias(f"{prefix}{m.name}{suffix}"))
    return cols


def metric_pack(df, days: Column | int | None, targets: tuple[str, ...] | None = ("brand", "seller"),
                prefix: str = "", suffix: str = "", keep: list[str] | None = None):
    """Select ``keep`` columns plus the metric pack over summed measures in ``df``."""
    spec = metric_spec(targets)
    base = {b: F.col(b) for b in base_measures(targets)}
    keep_cols = [F.col(c) for c in (keep or [])]
    return df.select(*keep_cols, *metric_columns(spec, base, days, prefix, suffix))


def metric_sql(spec: list[Metric], base: dict[str, str], days: str, prefix: str = "", suffix: str = "") -> list[str]:
    """SQL text of the same spec (DuckDB dialect) for oracles."""
    out = []
    for m in spec:
        num = " ".join(("+ " if sign > 0 else "- ") + base[name] for name, sign in m.numerator).lstrip("+ ")
        den = days if m.denominator == DAYS else base[m.denominator]
        out.append(f"({num}) / nullif({den}, 0) as {prefix}{m.name}{suffix}")
    return out
