"""Structured Streaming forms of the operators.

Each function takes a streaming DataFrame (readings: ``id, ts, temperature,
seq`` with ``ts`` a TIMESTAMP) and returns a streaming DataFrame; the caller
chooses sink, trigger and checkpoint location.  Stateful operators are
``groupBy(key).transformWithStateInPandas`` with RocksDB state; windowed aggregates
reuse the batch functions on a watermarked stream.

Rows without an event time have no place in the order and are left out.
``delay`` is the watermark delay; ``clock``, a predicate, lets only matching rows
move the watermark (T4), and then no row is ever dropped as late: one that comes
behind the watermark is folded when it comes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairo.functions.windowing import tumbling
from kairo.operators.rise import MESSAGE
from kairo.operators.windows import window_agg
from kairo.streaming import processors as P
from kairo.streaming.time import as_event_time, bounded_out_of_order, never_late

ALERT = "t long, seq long, temperature double, temp_diff double"
#: Time buckets that a key's buffer is cut into, over the length of the delay.
BUCKETS = 32


def _interval_us(spark: SparkSession, text: str) -> int:
    v = spark.sql(f"SELECT INTERVAL {text} AS i").first()["i"]
    return int(v.total_seconds() * 1_000_000)


def _key_type(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def _value(df: DataFrame) -> DataFrame:
    """A null reading is told apart from NaN by a column of its own."""
    return df.withColumns({"_some": F.col("temperature").isNotNull(),
                           "temperature": F.coalesce(F.col("temperature").cast("double"), F.lit(0.0))})


def _ordered(df: DataFrame, delay: str, clock: Column | None = None) -> DataFrame:
    """Watermark, and the columns that ordered processors read: the event
    time as LONG microseconds and the source (1 for readings)."""
    df = as_event_time(df).filter("ts IS NOT NULL")
    df = bounded_out_of_order(df, "ts", delay) if clock is None else never_late(
        df, "ts", delay, when=clock)
    df = df.withColumn("_t", F.unix_micros("ts"))
    return df if "_src" in df.columns else df.withColumn("_src", F.lit(1))


def _times(out: DataFrame, **named: str) -> DataFrame:
    """LONG microseconds back to timestamps: ``t`` to ``ts``, and ``named``."""
    named = {"t": "ts", **named}
    return out.select(*[F.timestamp_micros(c).alias(named[c]) if c in named else F.col(c)
                        for c in out.columns])


def _state_rows(df: DataFrame, by: list[str], fields: list[str]) -> GroupedData:
    """The grouped columns that a processor reads, and the watermark's.  Own columns
    begin with an underscore here and lose it, as Python's field names must."""
    wm = next(c for c in ("_wm", "ts", "et") if c in df.columns)
    named = [F.col(f"_{n}" if f"_{n}" in df.columns else n).alias(n) for n in fields]
    # pandas has no null numbers: a null key is a number and a flag
    first = F.col(by[0])
    if isinstance(df.schema[by[0]].dataType, T.NumericType):
        first = F.coalesce(first, F.lit(0).cast(df.schema[by[0]].dataType))
    keys = [first.alias("key"), *[F.col(c).alias(f"key{i}") for i, c in enumerate(by[1:], 2)],
            F.col(by[0]).isNull().cast("int").alias("no_key")]
    return df.select(*keys, *named, F.col(wm).alias("wm")).groupBy(
        "key", *[f"key{i}" for i in range(2, len(by) + 1)], "no_key")


_NULL = "\0"


def _as_payload(key: str) -> Column:
    """A key that is no grouping column goes as text, null as a text of its own."""
    return F.coalesce(F.col(key).cast("string"), F.lit(_NULL))


def _from_payload(out: DataFrame, kind: str) -> DataFrame:
    return out.withColumn("id", F.when(F.col("id") != _NULL, F.col("id").cast(kind)))


def _fold(df: DataFrame, by: str, processor: P.Ordered, schema: str, *, delay: str,
          mode: str = "EventTime", id_type: str | None = None, expire: str | None = None,
          event_time: str = "") -> DataFrame:
    spark = df.sparkSession
    processor.bucket = max(60_000_000, _interval_us(spark, delay) // BUCKETS)
    processor.expire = _interval_us(spark, expire) if expire else None
    fields = [n for n, _ in (*P.ORDER, *processor.payload)]
    return _times(_state_rows(df, [by], fields).transformWithStateInPandas(
        processor, f"id {id_type or _key_type(df, by)}, {schema}", "Append", mode,
        eventTimeColumnName=event_time))


def jump_alert_stream(df: DataFrame, threshold: float = 1.7, *, initial: float | None = 0.0,
                      key: str = "id", delay: str = "5 seconds", clock: Column | None = None,
                      expire: str | None = None) -> DataFrame:
    """X1 stream.  ``expire`` forgets a key that long after its last row, by event
    time, also if it never returns."""
    return _fold(_ordered(_value(df), delay, clock), key, P.JumpAlert(threshold, initial), ALERT,
                 delay=delay, expire=expire)


def jump_alert_ttl_stream(df: DataFrame, threshold: float = 1.5, ttl: str = "1 hour", *,
                          key: str = "id", delay: str = "5 seconds",
                          clock: Column | None = None) -> DataFrame:
    """X2 stream: an event-time deadline clears a key's state ``ttl`` after
    its last row (the built-in state TTL is processing-time only)."""
    return jump_alert_stream(df, threshold, key=key, delay=delay, clock=clock, expire=ttl)


def running_count_stream(df: DataFrame, predicate: Column, *, key: str = "id",
                         delay: str = "5 seconds", clock: Column | None = None,
                         expire: str | None = None) -> DataFrame:
    """A9 stream: one row per matching input with the key's running count."""
    matched = df.filter(predicate).withColumn("bucket", F.lit(0))
    return _fold(_ordered(matched, delay, clock), key, P.RunningCount(),
                 "ts timestamp, seq long, bucket int, keyed_count long",
                 delay=delay, expire=expire).drop("bucket")


def keyed_and_bucket_counts_stream(df: DataFrame, predicate: Column, bucket: Column, *,
                                   key: str = "id", delay: str = "5 seconds") -> DataFrame:
    """A10 stream: two stateful operators in one query, the key's running count and
    then the bucket's: ``(id, ts, seq, bucket, keyed_count, bucket_count)``.  The
    first hands its rows on with their event time, so the second waits for the same
    watermark and counts in the same order."""
    matched = df.filter(predicate).withColumn("bucket", bucket.cast("int"))
    counted = _fold(_ordered(matched, delay), key, P.RunningCount(),
                    "ts timestamp, seq long, bucket int, keyed_count long", delay=delay,
                    event_time="ts")
    both = counted.withColumns({"_t": F.unix_micros("ts"), "_src": F.lit(1), "id": _as_payload("id")})
    out = _fold(both, "bucket", P.BucketCount(),
                "t long, seq long, bucket int, keyed_count long, bucket_count long",
                delay="0 seconds", id_type="string")
    return _from_payload(out, _key_type(df, key))


def bucket_counts_stream(df: DataFrame, predicate: Column, bucket: Column, *,
                         delay: str = "5 seconds") -> DataFrame:
    """A11 stream: matching rows with only their bucket's running count."""
    matched = df.filter(predicate).withColumns({"id": bucket.cast("int"), "bucket": F.lit(0)})
    return _fold(_ordered(matched, delay), "id", P.RunningCount(),
                 "ts timestamp, seq long, bucket int, keyed_count long", delay=delay) \
        .select(F.col("id").alias("bucket"), "ts", "seq", F.col("keyed_count").alias("count"))


def rolling_sum_stream(df: DataFrame, *, key: str = "id", delay: str = "5 seconds",
                       expire: str | None = None) -> DataFrame:
    """A1 stream: every row with the running sum of its key's readings."""
    return _fold(_ordered(_value(df), delay), key, P.RollingSum(),
                 "t long, seq long, temperature double", delay=delay, expire=expire)


def rolling_argmax_stream(df: DataFrame, *, key: str = "id", delay: str = "5 seconds",
                          expire: str | None = None) -> DataFrame:
    """A2 stream: every row with its key's record of the highest reading so far
    (``max_temperature, max_ts, max_seq``), the newer one on a tie."""
    out = _fold(_ordered(_value(df), delay), key, P.RollingArgMax(),
                "t long, seq long, max_temperature double, max_t long, max_seq long",
                delay=delay, expire=expire)
    return _times(out, max_t="max_ts")


def _union(readings: DataFrame, control: DataFrame) -> DataFrame:
    r = readings.withColumn("_src", F.lit(1))
    c = control.withColumn("_src", F.lit(0))
    return r.unionByName(c, allowMissingColumns=True)


def gate_stream(readings: DataFrame, switches: DataFrame, *, key: str = "id",
                delay: str = "5 seconds", processing_time: bool = False) -> DataFrame:
    """J1 stream: readings and switches keyed together.
    ``processing_time=True``: the reference's wall-clock gate (T6), for
    continuously running queries (a ``processingTime`` trigger)."""
    sw = as_event_time(switches).select(
        key, "ts", F.lit(-1).cast("long").alias("seq"),
        (F.col("duration_ms") * 1000).alias("duration_us"))
    r = as_event_time(readings).select(key, "ts", "temperature", "seq")
    u = _value(_ordered(_union(r, sw), delay)).withColumns(
        {"ts_us": F.col("_t"), "duration_us": F.coalesce("duration_us", F.lit(-1))})
    return _fold(u, key, P.Gate(processing_time), "t long, temperature double, seq long",
                 delay=delay, mode="ProcessingTime" if processing_time else "EventTime")


def _thresholds(readings: DataFrame, thresholds: DataFrame, delay: str) -> DataFrame:
    return _value(_ordered(_union(readings, thresholds), delay)).withColumns(
        {"_set": F.col("threshold").isNotNull(), "threshold": F.coalesce("threshold", F.lit(0.0))})


def threshold_alert_stream(readings: DataFrame, thresholds: DataFrame, *, key: str = "id",
                           delay: str = "5 seconds", expire: str | None = None) -> DataFrame:
    """J3 + X4 stream.  Updates name their key, so they are keyed with the
    readings — no broadcast of the control stream is needed."""
    th = as_event_time(thresholds).select(key, "ts", "seq", "threshold")
    r = as_event_time(readings).select(key, "ts", "seq", "temperature")
    return _fold(_thresholds(r, th, delay), key, P.ThresholdAlert(), ALERT, delay=delay,
                 expire=expire)


def _buckets(df: DataFrame, buckets: int | None) -> int:
    return buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _every_bucket(control: DataFrame, n: int) -> DataFrame:
    return control.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def broadcast_threshold_stream(readings: DataFrame, thresholds: DataFrame, *, key: str = "id",
                               buckets: int | None = None, delay: str = "5 seconds") -> DataFrame:
    """J3 + X4 stream with the control stream broadcast into map state (K5): every
    bucket of readings holds the whole threshold table, which updates put into and
    remove from.  Control rows, few against readings, are copied to each bucket."""
    n = _buckets(readings, buckets)
    id = _as_payload(key).alias("id")
    th = _every_bucket(as_event_time(thresholds).select(id, "ts", "seq", "threshold"), n)
    r = as_event_time(readings).select(
        id, "ts", "seq", "temperature",
        F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int").alias("_b"))
    out = _fold(_thresholds(r, th, delay), "_b", P.ThresholdTable(), ALERT, delay=delay,
                id_type="string")
    return _from_payload(out, _key_type(readings, key))


def fire_risk_stream(readings: DataFrame, levels: DataFrame, *, above: float = 100.0,
                     buckets: int | None = None, key: str = "id",
                     delay: str = "5 seconds") -> DataFrame:
    """J2 + X5 stream.  The un-keyed level stream is replicated to
    ``buckets`` buckets (by default one per shuffle partition; control rows
    are few) and readings are keyed by a hash of their key, so the level state
    is held per bucket and the readings spread over as many tasks."""
    n = _buckets(readings, buckets)
    lv = _every_bucket(as_event_time(levels).select("ts", "seq", "level"), n)
    r = as_event_time(readings).select(
        _as_payload(key).alias("id"), "ts", "seq", "temperature",
        F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int").alias("_b"))
    out = _fold(_value(_ordered(_union(r, lv), delay)), "_b", P.LatestLevel(above),
                "t long, message string", delay=delay, id_type="string")
    return _from_payload(out, _key_type(readings, key))


def rise_alert_stream(df: DataFrame, hold: str = "1 second", *, key: str = "id",
                      delay: str = "5 seconds", clock: Column | None = None,
                      processing_time: bool = False) -> DataFrame:
    """X3 stream: deadlines fire once the watermark passes them;
    ``processing_time=True`` arms wall-clock timers as the reference does (T6)."""
    msg = MESSAGE % ("%s", hold)          # key filled in per alert
    hold_us = _interval_us(df.sparkSession, hold)
    return _fold(_ordered(_value(df), delay, clock), key,
                 P.RiseAlert(hold_us, msg, processing_time), "t long, message string",
                 delay=delay, mode="ProcessingTime" if processing_time else "EventTime")


def late_rows_stream(df: DataFrame, *, bound: str = "5 seconds", key: str = "id",
                     et: str = "et") -> DataFrame:
    """L2 + L4 stream: every row with its ``late`` flag and the key's running
    late count.  A row is late if its event time is below the watermark of its
    micro-batch, ``bound`` behind the largest event time of all *earlier*
    micro-batches; the batch form judges by every earlier row.  The shorter
    the trigger, the closer the two."""
    df = never_late(as_event_time(df, et), et, bound).filter(F.col(et).isNotNull())
    out = _state_rows(df.withColumn("_t", F.unix_micros(et)), [key], ["t", "seq"]) \
        .transformWithStateInPandas(
            P.LateDetector(), f"id {_key_type(df, key)}, ts timestamp, seq long, late boolean, "
                              "late_count long", "Append", "EventTime")
    return out.withColumnRenamed("ts", "et")


def late_report_stream(df: DataFrame, *, bound: str = "5 seconds", every: str = "30 seconds",
                       key: str = "id", et: str = "et") -> DataFrame:
    """L4 stream: ``(id, tick, late_count)``, a key's late rows so far, reported
    every ``every`` of processing time from its first late row on.  The detector and
    the report are two stateful operators of one query; run it with a
    ``processingTime`` trigger."""
    late = late_rows_stream(df, bound=bound, key=key, et=et).filter("late")
    ms = _interval_us(df.sparkSession, every) // 1000
    out = _state_rows(late, ["id"], ["seq"]).transformWithStateInPandas(
        P.LateReport(ms), f"id {_key_type(df, key)}, tick long, late_count long", "Append",
        "ProcessingTime")
    return _times(out, tick="tick")


def _windows(df: DataFrame, key: str, et: str, bound: str, size: str) -> DataFrame:
    """Rows with their window's end, none ever dropped as late."""
    df = as_event_time(df, et).filter(F.col(et).isNotNull())
    df = df.withColumn("_end", F.unix_micros(tumbling(et, size).end))
    return never_late(df, et, bound).withColumn("_t", F.unix_micros(et))


def late_window_stream(df: DataFrame, *, bound: str = "5 seconds", size: str = "10 seconds",
                       key: str = "id", et: str = "et") -> DataFrame:
    """L1 stream, two tagged outputs: ``kind`` ``main`` has a window's count
    ``(id, end_ts, cnt)``, written when the watermark passes its end; ``late`` has
    each row ``(id, end_ts, et, seq)`` that came after that.  The watermark is that
    of the micro-batch."""
    w = _windows(df, key, et, bound, size)
    out = _state_rows(w, [key, "_end"], ["t", "seq", "end"]).transformWithStateInPandas(
        P.LateWindow(), f"id {_key_type(df, key)}, kind string, end long, cnt long, et long, "
                        "seq long", "Append", "EventTime")
    return _times(out, end="end_ts", et="et")


def late_updates_stream(df: DataFrame, *, bound: str = "5 seconds", size: str = "10 seconds",
                        allowance: str = "5 seconds", key: str = "id", et: str = "et",
                        tag_scope: str = "window") -> DataFrame:
    """L3 stream: ``(id, end_ts, cnt, tag)``, a window's count when the watermark
    passes its end (``first``) and with every late row inside the allowance
    (``update``).  ``tag_scope="key"`` says ``update`` for all but a key's very first
    emission.  The watermark is that of the micro-batch."""
    if tag_scope not in ("window", "key"):
        raise ValueError("tag_scope is 'window' or 'key'")
    by_key = tag_scope == "key"
    w = _windows(df, key, et, bound, size)
    by = [key] if by_key else [key, "_end"]
    out = _state_rows(w, by, ["t", "seq", "end"]).transformWithStateInPandas(
        P.LateUpdates(_interval_us(df.sparkSession, allowance), by_key),
        f"id {_key_type(df, key)}, end long, cnt long, tag string", "Append", "EventTime")
    return _times(out, end="end_ts")


def early_fire_stream(df: DataFrame, *, size: str = "1 minute", pane: str = "1 second",
                      key: str = "id", delay: str = "5 seconds") -> DataFrame:
    """W3 stream at exact event-time cadence: the rows of ``early_fire``, each
    written when the watermark passes its ``fire_ts``."""
    d = _value(_ordered(df, delay)).withColumn("_end", F.unix_micros(tumbling("ts", size).end))
    out = _state_rows(d, [key, "_end"], ["t", "end", "temperature", "some"]) \
        .transformWithStateInPandas(
            P.EarlyFire(_interval_us(df.sparkSession, pane)),
            f"id {_key_type(df, key)}, end long, fire long, t long, temperature double, "
            "final boolean", "Append", "EventTime")
    return _times(out, end="end_ts", fire="fire_ts")


def window_agg_stream(df: DataFrame, key: str, size: str, aggs: dict[str, Column], *,
                      delay: str = "5 seconds") -> DataFrame:
    """A3–A8 stream: the batch plan on a watermarked stream.  In Append mode
    a window is written once, when the watermark passes its end (W5); in
    Update mode each trigger writes the windows that changed (early firing,
    W3 with ``trigger(processingTime=...)``)."""
    return window_agg(bounded_out_of_order(df, "ts", delay), key, "ts", size, aggs)


def observe_stream(df: DataFrame, name: str = "alerts") -> DataFrame:
    """A12 stream: a per-micro-batch counter, reported in
    ``query.lastProgress['observedMetrics'][name]``."""
    return df.observe(name, F.count(F.lit(1)).alias(name))


def read_state(spark: SparkSession, checkpoint: str, state_var: str | None = None,
               operator_id: int = 0) -> DataFrame:
    """Read a stream's keyed state (``key, value, partition_id``) from
    its checkpoint with the state data source."""
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if state_var:
        reader = reader.option("stateVarName", state_var)
    return reader.load(checkpoint)
