"""Row windows over one bar series per ticker.

A bar table holds one row per (ticker, date). ``date`` is a DATE, so a ticker has at most one row for
each calendar day and a task that orders one ticker is bounded by the calendar, whatever the volume of
the raw data behind the bars. Series without such a bound (metric samples, ticks, feature logs) go
through :mod:`tickloom.functions.slices` instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

KEYS = ("ticker",)
ORDER = "date"


def bars_window(keys: Sequence[str] = KEYS, order: str = ORDER) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def last_rows(n: int, w: WindowSpec | None = None) -> WindowSpec:
    return (w or bars_window()).rowsBetween(-(n - 1), Window.currentRow)


def running(w: WindowSpec | None = None) -> WindowSpec:
    return (w or bars_window()).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def rolling(agg: Callable[[Column], Column], x: Column, n: int, w: WindowSpec | None = None) -> Column:
    """``agg`` over the last ``n`` rows, null until ``n`` of them hold a value."""
    frame = last_rows(n, w)
    return F.when(F.count(x).over(frame) >= n, agg(x).over(frame))


def pct_change(x: Column, w: WindowSpec | None = None) -> Column:
    return F.try_divide(x, F.lag(x).over(w or bars_window())) - 1


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b as double, null where b is zero or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))
