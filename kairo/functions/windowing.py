"""Window assignment: tumbling windows and general assigners."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tumbling(ts: Column | str, size: str) -> Column:
    """Epoch-aligned, half-open ``[start, end)`` window struct."""
    return F.window(F.col(ts) if isinstance(ts, str) else ts, size)


def fixed_assigner(size: str) -> Callable[[Column], Column]:
    """W2 rule: one fixed-size window per row, as an array of
    ``struct<start, end>``.  Floors the time, so a row exactly on an edge
    belongs to the window starting there, and pre-1970 rows are right."""
    def assign(ts: Column) -> Column:
        w = F.window(ts, size)
        return F.array(F.struct(w.start.alias("start"), w.end.alias("end")))
    return assign


def assign_windows(df: DataFrame, ts: str, assigner: Callable[[Column], Column],
                   out: str = "window") -> DataFrame:
    """Apply a window assigner (a function of the time column returning
    ``array<struct<start, end>>``) and give each row once per window."""
    return df.withColumn(out, F.explode(assigner(F.col(ts))))
