"""Tumbling-window aggregates (A3–A8, A13) and early firing.

All window aggregates are one ``groupBy(key, window)``: Catalyst plans a
partial aggregate before the exchange and a final one after it, so a hot key
ships one buffer per (task, window), never its rows.  The same functions
work on streaming DataFrames (``withWatermark`` set by the caller, Append or
Update mode).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairo.functions.scalar import fahrenheit_to_celsius
from kairo.functions.windowing import tumbling


def window_agg(df: DataFrame, key: str, ts: str, size: str, aggs: dict[str, Column],
               *, end: str | None = "end_ts", start: str | None = None,
               window: Column | None = None) -> DataFrame:
    """Aggregate per key and tumbling window; the window appears as its end
    (W4) and/or start.  ``window`` overrides the assigned window column (e.g.
    an exploded W2 assignment)."""
    win = window if window is not None else tumbling(ts, size)
    g = df.groupBy(F.col(key), win.alias("_w")).agg(
        *[c.alias(n) for n, c in aggs.items()])
    cols = [F.col(key)]
    if start:
        cols.append(F.col("_w.start").alias(start))
    if end:
        cols.append(F.col("_w.end").alias(end))
    return g.select(*cols, *[F.col(n) for n in aggs])


def window_avg_celsius(df: DataFrame, key: str = "id", ts: str = "ts",
                       value: str = "temperature", size: str = "5 seconds") -> DataFrame:
    """A5 (+P3): average in °C per key and window, stamped with the window
    end: ``(id, end_ts, temperature)``."""
    return window_agg(df.withColumn(value, fahrenheit_to_celsius(value)), key, ts, size,
                      {value: F.avg(value)})


def window_avg(df: DataFrame, key: str = "id", ts: str = "ts",
               value: str = "temperature", size: str = "15 seconds") -> DataFrame:
    """A3: incremental average per key and window (mergeable buffer =
    Spark's partial/final ``avg``)."""
    return window_agg(df, key, ts, size, {value: F.avg(value)})


def window_min(df: DataFrame, key: str = "id", ts: str = "ts",
               value: str = "temperature", size: str = "15 seconds") -> DataFrame:
    """A4: window reduce to the minimum."""
    return window_agg(df, key, ts, size, {value: F.min(value)})


def window_min_max(df: DataFrame, key: str = "id", ts: str = "ts",
                   value: str = "temperature", size: str = "5 seconds") -> DataFrame:
    """``(id, min, max, end_ts)``.  The full-window and the
    pre-aggregate-then-decorate forms of the reference are the same plan
    here, since Catalyst always pre-aggregates."""
    return window_agg(df, key, ts, size, {"min": F.min(value), "max": F.max(value)})


def window_count(df: DataFrame, key: str = "id", ts: str = "ts",
                 size: str = "10 seconds") -> DataFrame:
    """``(id, end_ts, cnt)``."""
    return window_agg(df, key, ts, size, {"cnt": F.count(F.lit(1))})


def window_elementwise_max(df: DataFrame, key: str = "id", ts: str = "ts",
                           value: str = "temperature", size: str = "1 minute") -> DataFrame:
    """Maximum time and maximum value, each on its own (not an
    arg-max)."""
    return window_agg(df, key, ts, size, {ts: F.max(ts), value: F.max(value)})


def early_fire(df: DataFrame, key: str = "id", ts: str = "ts",
               value: str = "temperature", size: str = "1 minute",
               pane: str = "1 second") -> DataFrame:
    """W3 (+A13): a window that also fires early, once per ``pane`` of
    event time.

    From the pane of a window's first row on, every pane boundary before the
    window end emits the aggregate of the rows seen so far (``final`` false);
    the window end emits the complete aggregate once more and closes the
    window (``final`` true).  Aggregate: element-wise max of time and value.

    Plan: pre-aggregate per (key, window, pane) — partial aggregation, so a
    hot key ships one buffer per pane — then a running max over the panes
    of one window (at most ``size / pane`` rows per group) and one row per
    pane boundary up to the next pane with data.
    Output ``(id, end_ts, fire_ts, ts, temperature, final)``.
    """
    win = tumbling(ts, size)
    # one time-window expression per plan node: the pane end first
    with_pane = df.withColumn("_p", F.window(F.col(ts), pane).end)
    panes = (with_pane.groupBy(F.col(key), win.alias("_w"), F.col("_p"))
             .agg(F.max(ts).alias("_mt"), F.max(value).alias("_mv")))
    w = Window.partitionBy(key, "_w").orderBy("_p")
    run = panes.select(
        F.col(key), F.col("_w"), F.col("_p"),
        F.max("_mt").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(ts),
        F.max("_mv").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(value),
        F.lead("_p").over(w).alias("_next"))
    step = F.expr(f"interval {pane}")
    end = F.col("_w.end")
    upto = F.least(F.coalesce(F.col("_next"), end), end)
    # pane ends before the next pane with data (or the window's end); a pane that
    # ends after its window, where panes do not divide it, fires at the end only
    fires = F.when(F.col("_p") < upto, F.filter(
        F.sequence(F.col("_p"), upto, step), lambda t: t < upto))
    early = F.transform(F.coalesce(fires, F.array().cast("array<timestamp>")
                                   if df.schema[ts].dataType == T.TimestampType()
                                   else F.array().cast("array<timestamp_ntz>")),
                        lambda t: F.struct(t.alias("fire_ts"), F.lit(False).alias("final")))
    last = F.when(F.col("_next").isNull(), F.struct(end.alias("fire_ts"), F.lit(True).alias("final")))
    every = F.concat(early, F.array_compact(F.array(last)))
    return (run.select(F.col(key), end.alias("end_ts"), F.explode(every).alias("_f"),
                       F.col(ts), F.col(value))
            .select(key, "end_ts", "_f.fire_ts", ts, value, "_f.final"))
