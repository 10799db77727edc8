"""Event time and watermarks for streams.

``events.ts`` is TIMESTAMP_NTZ; ``withWatermark`` needs TIMESTAMP, so the
column is cast (the session zone is UTC).  The watermark interval of the
reference (T5) is the micro-batch trigger interval here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def bounded_out_of_order(df: DataFrame, ts: str = "ts", delay: str = "5 seconds") -> DataFrame:
    """watermark = max event time seen - ``delay``."""
    return as_event_time(df, ts).withWatermark(ts, delay)


def punctuated(df: DataFrame, when: Column, ts: str = "ts", delay: str = "60 seconds",
               out: str = "wm_ts") -> DataFrame:
    """T4: only rows matching ``when`` move the watermark (to their time -
    ``delay``).  Other rows carry a null watermark column, so they are never
    dropped and never move it."""
    df = as_event_time(df, ts)
    return df.withColumn(out, F.when(when, F.col(ts))).withWatermark(out, delay)


def never_late(df: DataFrame, et: str, delay: str, *, when: Column | None = None,
               out: str = "_wm") -> DataFrame:
    """A watermark that lags ``delay`` behind the largest event time (of the rows
    matching ``when``), and no row that Spark drops for it.

    Spark drops rows below the watermark before a stateful operator sees them.  So
    each row is doubled in place: a copy that only moves the watermark and ends here,
    before any exchange, and the row itself, whose watermark column ``out`` is null."""
    moves = F.col(et) if when is None else F.when(when, F.col(et))
    own = F.lit(None).cast("timestamp")
    both = df.withColumn(out, F.explode(F.when(moves.isNotNull(), F.array(own, moves))
                                         .otherwise(F.array(own))))
    # a predicate on the watermark column stays above the watermark
    return both.withWatermark(out, delay).filter(F.col(out).isNull())
