"""Watermarks over arrival order and late data, batch forms.

A stream's watermark after some arrivals is ``max(event time so far) -
bound``.  In batch the arrival order is a column (``seq``) and the watermark
*in effect for a row* is the running maximum of event time over the rows
that arrived **before** it, minus the bound — a global prefix scan, cut into
ordered chunks by ``kairo.plans.scan`` so it does not run in one task.

Late rules (``wm`` = watermark in effect, null before the first row):

* L2 — row late:                ``et < wm``
* L1 — row late for its window: ``window_end <= wm`` (the window has fired)
* L3 — row dropped:             ``window_end + allowance <= wm``
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairo.functions.windowing import tumbling
from kairo.plans.scan import Agg, prefix_scan
from kairo.schema import TAG_FIRST, TAG_UPDATE
from kairo.session import materialize


def _seconds(s: int) -> "F.Column":
    return F.expr(f"INTERVAL {int(s)} SECONDS")


def arrival_watermark(df: DataFrame, *, et: str = "et", arrival: str = "seq",
                      bound_s: int = 5, out: str = "wm") -> DataFrame:
    """Add the watermark in effect when each row arrives."""
    s = prefix_scan(df, [], [arrival], [Agg("_max_et", "max", et, inclusive=False)])
    return s.withColumn(out, F.col("_max_et") - _seconds(bound_s)).drop("_max_et")


def flag_late(df: DataFrame, *, et: str = "et", arrival: str = "seq",
              bound_s: int = 5) -> DataFrame:
    """L2: add ``wm`` and ``late = et < wm``."""
    w = arrival_watermark(df, et=et, arrival=arrival, bound_s=bound_s)
    return w.withColumn("late", F.coalesce(F.col(et) < F.col("wm"), F.lit(False)))


def late_rows(df: DataFrame, *, et: str = "et", arrival: str = "seq",
              bound_s: int = 5) -> DataFrame:
    """L2 side output: the late rows.  (The reference's main output is empty;
    ``flag_late(...).filter(~late)`` gives the on-time rows.)"""
    return flag_late(df, et=et, arrival=arrival, bound_s=bound_s).filter("late").drop("late")


def late_counts(df: DataFrame, *, key: str = "id", et: str = "et", arrival: str = "seq",
                bound_s: int = 5) -> DataFrame:
    """L4: number of late rows per key ``(id, late_count)``.  The reference
    reports this counter every 30 s of processing time; in batch the report
    is the final count."""
    f = flag_late(df, et=et, arrival=arrival, bound_s=bound_s)
    return (f.filter("late").groupBy(key)
             .agg(F.count(F.lit(1)).alias("late_count")))


def _windowed(df: DataFrame, et: str, arrival: str, bound_s: int, size: str) -> DataFrame:
    w = arrival_watermark(df, et=et, arrival=arrival, bound_s=bound_s)
    win = tumbling(et, size)
    return w.withColumn("_ws", win.start).withColumn("end_ts", win.end)


def late_window_split(df: DataFrame, *, key: str = "id", et: str = "et",
                      arrival: str = "seq", bound_s: int = 5,
                      size: str = "10 seconds") -> tuple[DataFrame, DataFrame]:
    """L1: window counts of on-time rows ``(id, end_ts, cnt)`` and the side
    output of rows that came after their window fired."""
    w = _windowed(df, et, arrival, bound_s, size)
    fired = F.coalesce(F.col("end_ts") <= F.col("wm"), F.lit(False))
    main = (w.filter(~fired).groupBy(key, "end_ts")
             .agg(F.count(F.lit(1)).alias("cnt")))
    late = w.filter(fired).select(*df.columns)
    return main, late


def late_updates(df: DataFrame, *, key: str = "id", et: str = "et", arrival: str = "seq",
                 bound_s: int = 5, size: str = "10 seconds",
                 allowance_s: int = 5, tag_scope: str = "window") -> DataFrame:
    """L3: window counts with allowed lateness, re-emitted per late row.

    When the watermark passes a window's end the window emits its count of
    on-time rows, tagged ``first``.  Each row arriving later, while the
    watermark is still below ``end + allowance``, joins the window and
    re-emits the new count, tagged ``update`` (``first`` if the window had
    not emitted yet).  Rows after that are dropped.  The tag is kept per
    window; with ``tag_scope="key"`` it is kept per key, as in the reference:
    every emission after a key's very first says ``update``.  A window emits
    before the first row whose watermark has passed its end.

    Since the watermark never decreases along arrival order, a window's
    on-time rows all arrive before its late ones, and its dropped rows after
    them; the count at a late row is the running count in arrival order.
    Output ``(id, end_ts, cnt, tag)``.
    """
    if tag_scope not in ("window", "key"):
        raise ValueError("tag_scope is 'window' or 'key'")
    w = _windowed(df, et, arrival, bound_s, size)
    fired = F.coalesce(F.col("end_ts") <= F.col("wm"), F.lit(False))
    dropped = F.coalesce(F.col("end_ts") + _seconds(allowance_s) <= F.col("wm"), F.lit(False))
    # written once: the second scan's statistics would repeat the first scan
    kept, _ = materialize(w.filter(~dropped).select(
        key, arrival, "_ws", "end_ts", "wm", fired.alias("_fired")), "late-rows")
    run = prefix_scan(kept, [key, "_ws"], [arrival], [
        Agg("cnt", "count", F.lit(1)),
        Agg("_ontime", "count", F.when(~F.col("_fired"), 1))])
    first = (run.filter(~F.col("_fired")).groupBy(key, "end_ts")
                .agg(F.max("cnt").alias("cnt"))
                .withColumn("tag", F.lit(TAG_FIRST)))
    if tag_scope == "key":
        # in the order of emission: a window when the watermark is at its end, a late
        # row at its own watermark
        out, _ = materialize(
            first.select(key, "end_ts", "cnt", F.col("end_ts").alias("_at"),
                         F.lit(-2 ** 63).alias("_k"))
            .unionByName(run.filter("_fired").select(
                key, "end_ts", "cnt", F.col("wm").alias("_at"),
                F.col(arrival).cast("long").alias("_k"))), "late-emitted")
        out = prefix_scan(out, [key], ["_at", "_k"], [Agg("_n", "count", F.lit(1))])
        return out.select(key, "end_ts", "cnt", F.when(F.col("_n") == 1, F.lit(TAG_FIRST))
                                                 .otherwise(F.lit(TAG_UPDATE)).alias("tag"))
    upd = (run.filter(F.col("_fired"))
              .withColumn("tag", F.when((F.col("_ontime") == 0) & (F.col("cnt") == 1),
                                        F.lit(TAG_FIRST)).otherwise(F.lit(TAG_UPDATE)))
              .select(key, "end_ts", "cnt", "tag"))
    return first.unionByName(upd)
