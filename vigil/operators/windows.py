"""Window building blocks (W1-W12) used across the operators.

All take the partition keys explicitly, so a "global" order is always made
per device (W12): a window without a partition key runs in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def ordered(keys, order: str = "when"):
    return Window.partitionBy(*keys).orderBy(order)


def lag_lead(col: str, keys, order: str = "when", default=None) -> tuple[Column, Column]:
    """Previous and next value in the group (with an optional default)."""
    w = ordered(keys, order)
    if default is None:
        return F.lag(col).over(w), F.lead(col).over(w)
    return F.lag(col, 1, default).over(w), F.lead(col, 1, default).over(w)


def running_sum(col, keys, order: str = "when") -> Column:
    """Running total with an explicit ROWS frame (Trap T6: the default
    RANGE frame gives tied rows the same total)."""
    return F.sum(col).over(ordered(keys, order).rowsBetween(Window.unboundedPreceding,
                                                            Window.currentRow))


def group_count(keys) -> Column:
    """Rows of the group, no ordering."""
    return F.count(F.lit(1)).over(Window.partitionBy(*keys))


def range_frame(keys, start: int, end: int, order: str = "when"):
    """A frame of seconds around the row (``order`` is a LONG)."""
    return ordered(keys, order).rangeBetween(start, end)


def rows_frame(keys, start: int, end: int, order: str = "when"):
    """A frame of rows around the row."""
    return ordered(keys, order).rowsBetween(start, end)


def next_non_null(col, keys, order: str = "when") -> Column:
    """First non-null value at or after the row: a running value in
    descending order (a frame that reaches ahead to the end would be worked
    out anew for every row)."""
    back = Window.partitionBy(*keys).orderBy(F.desc(order))
    return F.last(col, ignorenulls=True).over(
        back.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def last_non_null(col, keys, order: str = "when") -> Column:
    """Last non-null value at or before the row."""
    return F.last(col, ignorenulls=True).over(
        ordered(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def rolling_mean(col, keys, seconds: int, order: str = "when") -> Column:
    """Mean over the past ``seconds`` (current row included)."""
    return F.avg(col).over(range_frame(keys, -seconds, 0, order))


def rolling_sum(col, keys, seconds: int, order: str = "when") -> Column:
    """Sum over the past ``seconds`` (current row included)."""
    return F.sum(col).over(range_frame(keys, -seconds, 0, order))


def position(keys, order, start: int = 1) -> Column:
    """Row position in the group (``start`` = first position)."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - (1 - start)
