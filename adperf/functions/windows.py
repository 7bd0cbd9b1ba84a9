"""Day-window registry and the effective-day divisor (ops A2, B2, B30).

A window ``(far, near)`` covers ``anchor - far <= day <= anchor - near``; negative
offsets look forward (labels). Excluded days are removed from the scan and from
the divisor.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DayWindow:
    name: str
    far: int
    near: int

    def bounds(self, anchor: dt.date) -> tuple[dt.date, dt.date]:
        return anchor - dt.timedelta(days=self.far), anchor - dt.timedelta(days=self.near)

    @property
    def length(self) -> int:
        return self.far - self.near + 1


def as_date(d: str | dt.date) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


# Window registries of the reference configs, (far, near) in days.
WEEKLY_AD = [
    DayWindow("l", 6, 0), DayWindow("w1", 13, 7), DayWindow("w2", 20, 7),
    DayWindow("v2", 27, 14), DayWindow("v3", 34, 21), DayWindow("v4", 41, 28),
    DayWindow("v5", 48, 35), DayWindow("v9", 76, 63), DayWindow("v12", 97, 84),
    DayWindow("v18", 139, 126),
]
WEEKLY_CATALOG = [DayWindow("w1", 13, 7)]
WEEKLY_SITE = [DayWindow("w1", 13, 7), DayWindow("w2", 20, 7)]
MONTHLY_LABELS = [DayWindow("l1", 0, -6), DayWindow("l2", 0, -13), DayWindow("l3", 0, -20), DayWindow("l4", 0, -27)]
MONTHLY_AD = [
    DayWindow("m1", 30, 1), DayWindow("m2", 60, 31), DayWindow("m3", 90, 61),
    DayWindow("m4", 120, 91), DayWindow("m5", 150, 121),
]
MONTHLY_CATALOG = [DayWindow("w1", 7, 1)]
MONTHLY_SITE = [DayWindow("w1", 7, 1), DayWindow("w2", 14, 1)]

# Click thresholds of the click-bucket features and the first-N label.
CLICK_THRESHOLDS = [0, 150, 300, 450, 600, 750]
FIRST_N_CLICKS = 150


def window_filter(day: Column | str, anchor: str | dt.date, window: DayWindow,
                  excluded: list[str] | tuple[str, ...] = ()) -> Column:
    """Typed date predicate (op A2): pushes down to the Parquet scan."""
    day = F.col(day) if isinstance(day, str) else day
    lo, hi = window.bounds(as_date(anchor))
    cond = day.between(F.lit(lo), F.lit(hi))
    if excluded:
        cond = cond & ~day.isin([F.lit(as_date(d)) for d in excluded])
    return cond


def span_filter(day: Column | str, anchor: str | dt.date, windows: list[DayWindow],
                excluded: list[str] | tuple[str, ...] = ()) -> Column:
    """One predicate covering the union span of several windows (one scan for all)."""
    far = max(w.far for w in windows)
    near = min(w.near for w in windows)
    return window_filter(day, anchor, DayWindow("span", far, near), excluded)


def segments(windows: list[DayWindow]) -> list[tuple[int, int]]:
    """Disjoint (near, far) spans, ascending, cut at the ends of all windows: each window is a union of some of them."""
    cuts = sorted({w.near for w in windows} | {w.far + 1 for w in windows})
    return [(a, b - 1) for a, b in zip(cuts, cuts[1:], strict=False) if any(w.near <= a and b - 1 <= w.far for w in windows)]


def effective_days(anchor: str | dt.date, window: DayWindow,
                   excluded: list[str] | tuple[str, ...] = ()) -> int:
    """Window length minus excluded days inside it (op B2); may be 0."""
    lo, hi = window.bounds(as_date(anchor))
    inside = {as_date(d) for d in excluded if lo <= as_date(d) <= hi}
    return window.length - len(inside)


def anchor_days(start: str | dt.date, count: int = 5, step: int = 14) -> list[dt.date]:
    """The start day and ``count - 1`` earlier days ``step`` apart (op B30)."""
    s = as_date(start)
    return [s - dt.timedelta(days=step * i) for i in range(count)]
