"""Keyed stateful alerts, batch forms.

X1/X2 are a previous-value lookup (a prefix scan of "last value before this
row"), X3 is a true fold whose re-arming chain is resolved with pointer
doubling in ``kairo.operators.rise``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairo.functions.scalar import abs_diff
from kairo.plans.scan import Agg, prefix_scan


def jump_alert(df: DataFrame, key: str = "id", order: Sequence[str] = ("ts", "seq"),
               value: str = "temperature", threshold: float = 1.7, *,
               initial: float | None = 0.0) -> DataFrame:
    """Alert when ``|value - previous value of the key| > threshold``.

    The first reading of a key compares with ``initial`` (0.0 as in the
    reference, where unset state reads as zero, so a first reading with
    ``|value| > threshold`` alerts); ``initial=None`` never alerts on a first
    reading.  A null reading never alerts, and the reading after it has nothing
    to compare with, so it does not alert either.
    Output ``(id, ts, temperature, temp_diff)`` (+ order columns).
    """
    order = list(order)
    s = prefix_scan(df, [key], order, [Agg("_prev", "last", F.struct(F.col(value).alias("v")),
                                           inclusive=False)])
    prev = F.when(F.col("_prev").isNull(), F.lit(initial)).otherwise(F.col("_prev.v"))
    s = s.withColumn("temp_diff", abs_diff(value, prev))
    return (s.filter(F.col("temp_diff") > F.lit(threshold))
             .select(key, *order, value, "temp_diff"))


def jump_alert_ttl(df: DataFrame, key: str = "id", order: Sequence[str] = ("ts", "seq"),
                   value: str = "temperature", threshold: float = 1.5,
                   ttl_seconds: int = 3600) -> DataFrame:
    """X1 whose per-key state is cleared ``ttl`` of event time after the
    key's last row: a row whose gap to the previous row of the key is
    ``>= ttl`` compares with 0.0 again.

    (The reference clears on a timer that waits for the watermark, so a row
    up to the watermark delay past the hour may still see old state; here
    the gap rule is exact in event time.)  Null readings count as in X1.
    """
    order = list(order)
    ts = order[0]
    s = prefix_scan(df, [key], order, [Agg("_prev", "last", F.struct(F.col(value).alias("v")),
                                           inclusive=False),
                                       Agg("_prev_ts", "last", ts, inclusive=False)])
    fresh = F.col("_prev_ts").isNull() | (
        F.col(ts) >= F.col("_prev_ts") + F.make_dt_interval(secs=F.lit(ttl_seconds)))
    prev = F.when(fresh, F.lit(0.0)).otherwise(F.col("_prev.v"))
    s = s.withColumn("temp_diff", abs_diff(value, prev))
    return (s.filter(F.col("temp_diff") > F.lit(threshold))
             .select(key, *order, value, "temp_diff"))
