"""Stream = batch parity: replay sf0.001 ``events`` in several micro-batches
through each streaming form and compare with the batch form."""

import tempfile
import time

import pytest
from pyspark.sql import functions as F

from kairo import operators as op
from kairo import streaming as st
from kairo.sources.replay import replay_stream, split_for_replay
from kairo.sources.tables import (
    levels_from_events, switches_from_events, thresholds_from_events,
)
from conftest import SF0001

SLICES = 4


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Two state stores an operator: enough to deal keys out, quicker to commit."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def events(spark):
    """The table, with some null readings (and so null control values)."""
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumns({
        "ts": F.col("ts").cast("timestamp"),
        "value": F.when(F.col("event_id") % 13 != 0, F.col("value"))})
    return ev


@pytest.fixture(scope="module", params=["in order", "interleaved"])
def replay_dir(spark, events, request):
    """Four arrival slices, in event-time order or dealt by a hash, and then
    rows of another key far in the future, whose watermark closes the stream."""
    path = tempfile.mkdtemp(prefix="kairo-replay-") + "/events"
    arrival = F.col("event_id") if request.param == "in order" else F.xxhash64("event_id")
    split_for_replay(events.withColumn("_arr", arrival), path, SLICES, order="_arr")
    split_for_replay(closing(spark), path, 2, order="_arr")
    return path


def closing(spark):
    close = spark.createDataFrame([(10 ** 9 + i, -1, "view", 500.0, f"{2030 + i}-01-01") for i in range(2)],
                                  "event_id long, user_id long, event_type string, value double, t string")
    return close.withColumn("ts", F.col("t").cast("timestamp")).withColumn("_arr", F.col("event_id"))


DELAY = "400 days"


def run(df, mode="append"):
    name = "q" + tempfile.mktemp(prefix="", dir="").replace("-", "_")[-10:]
    ck = tempfile.mkdtemp(prefix="kairo-ck-")
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name), q, ck


def stream_events(spark, replay_dir, events):
    return replay_stream(spark, replay_dir, events.schema)


def readings_of(ev):
    return ev.select(F.col("user_id").alias("id"), "ts", F.col("value").alias("temperature"),
                     F.col("event_id").alias("seq"), "event_type")


def same(a, b, cols):
    a, b = (d.filter("id >= 0") for d in (a, b))
    ra = sorted(tuple(r) for r in a.select(*cols).collect())
    rb = sorted(tuple(r) for r in b.select(*cols).collect())
    assert ra == rb
    return len(ra)


def test_jump_alert_parity_and_state_reader(spark, events, replay_dir):
    s = readings_of(stream_events(spark, replay_dir, events))
    out, q, ck = run(st.jump_alert_stream(s, 1.7, delay=DELAY))
    assert q.lastProgress is not None
    n = same(out, op.jump_alert(readings_of(events), threshold=1.7),
             ["id", "ts", "seq", "temperature", "temp_diff"])
    assert n > 0
    state = st.read_state(spark, ck, "last")
    got = {r["key"][0]: r["value"][0] for r in state.collect()}
    last = (readings_of(events).groupBy("id")
            .agg(F.max_by("temperature", F.struct("ts", "seq")).alias("v")).collect())
    assert {k: v for k, v in got.items() if k >= 0} == {r["id"]: r["v"] for r in last}


def test_jump_alert_ttl_parity(spark, events, replay_dir):
    s = readings_of(stream_events(spark, replay_dir, events))
    out, _, _ = run(st.jump_alert_ttl_stream(s, 1.5, "1 day", delay=DELAY))
    same(out, op.jump_alert_ttl(readings_of(events), threshold=1.5, ttl_seconds=86400),
         ["id", "ts", "seq", "temperature", "temp_diff"])


def test_running_count_parity(spark, events, replay_dir):
    s = readings_of(stream_events(spark, replay_dir, events))
    out, _, _ = run(st.running_count_stream(s, F.col("temperature") > 120, delay=DELAY))
    same(out, op.running_count(readings_of(events), "id", ["ts", "seq"],
                               F.col("temperature") > 120), ["id", "ts", "seq", "keyed_count"])


def test_gate_parity(spark, events, replay_dir):
    s = stream_events(spark, replay_dir, events)
    r_s = readings_of(s.filter("event_type <> 'signup'"))
    out, _, _ = run(st.gate_stream(r_s, switches_from_events(s, "signup", 2 * 86_400_000),
                                   delay=DELAY))
    batch = op.gate(readings_of(events.filter("event_type <> 'signup'")),
                    switches_from_events(events, "signup", 2 * 86_400_000))
    assert same(out, batch, ["id", "ts", "seq", "temperature"]) > 0


def test_threshold_alert_parity(spark, events, replay_dir):
    s = stream_events(spark, replay_dir, events)
    out, _, _ = run(st.threshold_alert_stream(readings_of(s.filter("event_type <> 'purchase'")),
                                              thresholds_from_events(s, "purchase", 5), delay=DELAY))
    batch = op.threshold_alert(readings_of(events.filter("event_type <> 'purchase'")),
                               thresholds_from_events(events, "purchase", 5))
    assert same(out, batch, ["id", "ts", "seq", "temperature", "temp_diff"]) > 0


def test_fire_risk_parity(spark, events, replay_dir):
    s = stream_events(spark, replay_dir, events)
    out, _, _ = run(st.fire_risk_stream(readings_of(s.filter("event_type <> 'error'")),
                                        levels_from_events(s, "error", 80.0), delay=DELAY))
    batch = op.fire_risk(readings_of(events.filter("event_type <> 'error'")),
                         levels_from_events(events, "error", 80.0))
    assert same(out, batch, ["id", "ts", "message"]) > 0


def test_rise_alert_parity(spark, events, replay_dir):
    s = readings_of(stream_events(spark, replay_dir, events))
    out, q, _ = run(st.rise_alert_stream(s, "2 hours", delay=DELAY))
    # the batch form fires deadlines up to its last event time; here the
    # closing rows are part of its input too
    ev = readings_of(spark.read.schema(events.schema).parquet(replay_dir))
    assert same(out, op.rise_alert(ev, hold="2 hours"), ["id", "ts", "message"]) > 0


def test_window_agg_update_parity(spark, events, replay_dir):
    s = readings_of(stream_events(spark, replay_dir, events))
    out, _, _ = run(st.window_agg_stream(s, "id", "1 day", {"cnt": F.count(F.lit(1))}, delay=DELAY),
                    mode="update")
    final = out.groupBy("id", "end_ts").agg(F.max("cnt").alias("cnt"))
    batch = op.window_count(readings_of(events), size="1 day")
    assert same(final, batch, ["id", "end_ts", "cnt"]) > 0


def test_window_agg_append_emits_once(spark, events, replay_dir):
    """In Append mode a window is written once, when the watermark passes it."""
    s = readings_of(stream_events(spark, replay_dir, events))
    out, _, _ = run(st.window_agg_stream(s, "id", "1 day", {"cnt": F.count(F.lit(1))}, delay=DELAY))
    assert same(out, op.window_count(readings_of(events), size="1 day"), ["id", "end_ts", "cnt"]) > 0


def test_restart_from_checkpoint(spark, events):
    """Stop after part of the input, restart from the checkpoint: same rows."""
    path = tempfile.mkdtemp(prefix="kairo-replay-") + "/events"
    ck = tempfile.mkdtemp(prefix="kairo-ck-")
    half = events.filter("event_id < 500")
    split_for_replay(half, path, 2, order="event_id")

    def once():
        s = readings_of(replay_stream(spark, path, events.schema))
        q = (st.jump_alert_stream(s, 1.7, delay=DELAY).writeStream.format("parquet")
             .option("path", path + "-out").option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    once()
    split_for_replay(events.filter("event_id >= 500"), path, 2, order="event_id")
    split_for_replay(closing(spark), path, 2, order="event_id")
    once()
    out = spark.read.parquet(path + "-out")
    same(out, op.jump_alert(readings_of(events), threshold=1.7),
         ["id", "ts", "seq", "temperature", "temp_diff"])


def test_late_rows_stream_subset_of_batch(spark):
    from conftest import SF001
    from kairo.plans.catalog import with_disorder
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    r = with_disorder(readings_of(ev), seq="seq", ts="ts", out="et").withColumn(
        "et", F.col("et").cast("timestamp"))
    path = tempfile.mkdtemp(prefix="kairo-replay-") + "/late"
    split_for_replay(r, path, 8, order="seq")
    out, _, _ = run(st.late_rows_stream(replay_stream(spark, path, r.schema), bound="5 hours"))
    late_stream = {row["seq"] for row in out.filter("late").collect()}
    late_batch = {row["seq"] for row in op.late_rows(r, bound_s=5 * 3600).collect()}
    # the same rule at the same cadence: the watermark of all earlier slices
    slices = [x for x in sorted((f, spark.read.parquet(f)) for f in
                                spark.read.parquet(path).inputFiles())]
    want, top = set(), None
    for _, part in slices:
        rows = part.select("seq", F.unix_micros("et").alias("t")).collect()
        if top is not None:
            wm = (top - 5 * 3600 * 10 ** 6) // 1000 * 1000
            want |= {x.seq for x in rows if x.t < wm}
        top = max([x.t for x in rows] + ([top] if top is not None else []))
    assert out.count() == r.count()
    assert late_stream == want and late_stream <= late_batch and want
    counts = {row["id"]: row["n"] for row in
              out.groupBy("id").agg(F.max("late_count").alias("n")).collect()}
    assert sum(counts.values()) == len(late_stream)



def test_punctuated_watermark_router_and_counter(spark, events, replay_dir):
    """T4 (only some rows move the watermark), A12 (stream counter) and the
    foreachBatch router of a tagged side output (K6/X6)."""
    s = readings_of(stream_events(spark, replay_dir, events))
    p = st.punctuated(s, F.col("id") == 1, delay="1 hour")
    routed = st.observe_stream(op.freezing_monitor(p.drop("wm_ts")), "rows")
    seen = {"main": 0, "side": 0}

    def sink_for(kind):
        def sink(df, epoch):
            seen[kind] += df.count()
        return sink

    q = (routed.writeStream.foreachBatch(op.router({k: sink_for(k) for k in seen}))
         .option("checkpointLocation", tempfile.mkdtemp(prefix="kairo-ck-"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    n = events.count() + 2                      # with the closing rows
    assert seen["main"] == n
    assert seen["side"] == events.filter("value < 32").count()
    observed = [pr["observedMetrics"]["rows"]["rows"] for pr in q.recentProgress
                if pr.get("observedMetrics")]
    assert sum(observed) == n + seen["side"]


def test_rolling_sum_and_argmax_parity(spark, events, replay_dir):
    """A1 and A2 streams."""
    s = readings_of(stream_events(spark, replay_dir, events))
    out, _, _ = run(st.rolling_sum_stream(s, delay=DELAY))
    rounded = F.round("temperature", 6).alias("temperature")
    cols = ["id", "ts", "seq", "temperature"]
    batch = op.rolling_sum(readings_of(events), "id", ["ts", "seq"], "temperature", carry="current")
    key = lambda d: {(r.id, r.ts, r.seq): r.temperature for r in d.select(*cols[:3], rounded)
                     .filter("id >= 0").collect()}
    assert key(out) == key(batch)
    out, _, _ = run(st.rolling_argmax_stream(s, delay=DELAY))
    batch = op.rolling_argmax(readings_of(events), "id", ["ts", "seq"], "temperature")
    cols = ["id", "ts", "seq", "max_temperature", "max_ts", "max_seq"]
    key = lambda d: {(r.id, r.ts, r.seq): tuple(r)[3:] for r in d.select(*cols)
                     .filter("id >= 0").collect()}
    assert key(out) == key(batch)


def test_keyed_and_bucket_counts_parity(spark, events, replay_dir):
    """A10 (two chained stateful operators) and A11."""
    s = readings_of(stream_events(spark, replay_dir, events))
    hot, bucket = F.col("temperature") > 10, F.pmod(F.xxhash64("id"), F.lit(4)).cast("int")
    out, _, _ = run(st.keyed_and_bucket_counts_stream(s, hot, bucket, delay=DELAY))
    real = F.col("id") >= 0                      # the closing rows share a bucket
    batch = op.keyed_and_bucket_counts(readings_of(events), "id", ["ts", "seq"], hot, bucket)
    cols = ["id", "ts", "seq", "bucket", "keyed_count", "bucket_count"]
    assert same(out.filter(real), batch, cols) > 0
    out, _, _ = run(st.bucket_counts_stream(s, hot, bucket, delay=DELAY))
    batch = op.bucket_counts(readings_of(events), ["ts", "seq"], hot, bucket)
    cols = ["bucket", "ts", "seq", "count"]
    got = sorted(tuple(r) for r in out.filter("seq < 1000000000").select(*cols).collect())
    assert got == sorted(tuple(r) for r in batch.select(*cols).collect())


def test_threshold_broadcast_into_map_state(spark, events, replay_dir):
    """K5: readings keyed by a bucket, thresholds in every bucket's map state."""
    s = stream_events(spark, replay_dir, events)
    out, _, ck = run(st.broadcast_threshold_stream(
        readings_of(s.filter("event_type <> 'purchase'")),
        thresholds_from_events(s, "purchase", 5), buckets=3, delay=DELAY))
    batch = op.threshold_alert(readings_of(events.filter("event_type <> 'purchase'")),
                               thresholds_from_events(events, "purchase", 5))
    assert same(out, batch, ["id", "ts", "seq", "temperature", "temp_diff"]) > 0
    table = (spark.read.format("statestore").option("stateVarName", "thresholds")
             .load(ck).select("key.key", "user_map_key.id").distinct())
    per = {r["key"]: r["n"] for r in table.groupBy("key").agg(F.count("*").alias("n")).collect()}
    want = op.threshold_table(thresholds_from_events(events, "purchase", 5).filter(
        "threshold IS NOT NULL")).count()
    assert len(per) == 3 and set(per.values()) == {want}


def test_early_fire_parity(spark, events, replay_dir):
    """W3 at exact event-time cadence, though the watermark jumps over many panes."""
    s = readings_of(stream_events(spark, replay_dir, events))
    out, _, _ = run(st.early_fire_stream(s, size="1 day", pane="1 hour", delay=DELAY))
    batch = op.early_fire(readings_of(events), size="1 day", pane="1 hour")
    cols = ["id", "end_ts", "fire_ts", "ts", "temperature", "final"]
    key = lambda d: sorted(((*tuple(r)[:4], r[5], r[4] or 0.0) for r in d.select(*cols)
                            .filter("id >= 0").collect()))
    assert key(out) == key(batch) and len(key(out)) > 100


def test_expired_keys_are_gone(spark, events, replay_dir):
    """A key that does not return is forgotten by event time."""
    s = stream_events(spark, replay_dir, events)
    r = readings_of(s)
    th = thresholds_from_events(s, "purchase", 5)
    for stream, var in ((st.jump_alert_stream(r, delay=DELAY, expire="10 days"), "last"),
                        (st.running_count_stream(r, F.col("temperature") > 10, delay=DELAY,
                                                 expire="10 days"), "count"),
                        (st.threshold_alert_stream(readings_of(s.filter("event_type <> 'purchase'")),
                                                   th, delay=DELAY, expire="10 days"), "threshold")):
        _, _, ck = run(stream)
        left = {x["key"][0] for x in st.read_state(spark, ck, var).collect()}
        assert {k for k in left if k >= 0} == set(), var
        index = {x["key"][0] for x in st.read_state(spark, ck, "index").collect()}
        assert {k for k in index if k >= 0} == set(), var


# -- late data: the rule at the cadence of the micro-batches ---------------------------

def disordered(spark, n):
    """``(rows, folder, rows by slice)`` of late data; the last slice closes."""
    from conftest import SF001
    from kairo.plans.catalog import with_disorder
    ev = spark.read.parquet(f"{SF001}/events.parquet").filter("user_id < 100")
    r = with_disorder(readings_of(ev), seq="seq", ts="ts", out="et").withColumn(
        "et", F.col("et").cast("timestamp")).drop("event_type")
    path = tempfile.mkdtemp(prefix="kairo-replay-") + "/late"
    split_for_replay(r, path, n, order="seq")
    close = r.limit(1).select(F.lit(-1).cast("long").alias("id"), "ts", "temperature",
                              F.lit(10 ** 9).cast("long").alias("seq"),
                              F.lit("2040-01-01").cast("timestamp").alias("et")).select(*r.columns)
    split_for_replay(close, path, 1, order="seq")
    parts = [spark.read.parquet(f).select("id", "seq", F.unix_micros("et").alias("t"))
             .orderBy("seq").collect() for f in sorted(spark.read.parquet(path).inputFiles())]
    parts.sort(key=lambda p: p[0].seq)
    return r, path, parts


def cadence(parts, bound_us):
    """Every row with the watermark of its micro-batch."""
    top = None
    for part in parts:
        wm = None if top is None else (top // 1000 * 1000 - bound_us)
        yield from ((r, wm) for r in part)
        top = max([x.t for x in part] + ([] if top is None else [top]))


HOUR = 3600 * 10 ** 6


def _end(t, size):
    return t // size * size + size


def test_late_window_stream(spark):
    """L1: window counts and the rows that come after their window."""
    r, path, parts = disordered(spark, 8)
    out, _, _ = run(st.late_window_stream(replay_stream(spark, path, r.schema),
                                          bound="5 hours", size="2 hours"))
    main, late = {}, set()
    for x, wm in cadence(parts, 5 * HOUR):
        end = _end(x.t, 2 * HOUR)
        if wm is not None and end <= wm:
            late.add((x.id, end, x.t, x.seq))
        elif x.id >= 0:
            main[x.id, end] = main.get((x.id, end), 0) + 1
    us = [F.unix_micros(c).alias(c) for c in ("end_ts", "et")]
    rows = out.select("id", "kind", us[0], "cnt", us[1], "seq").collect()
    assert {(x.id, x.end_ts): x.cnt for x in rows if x.kind == "main" and x.id >= 0} == main
    assert sum(x.kind == "main" and x.id >= 0 for x in rows) == len(main)
    got = [(x.id, x.end_ts, x.et, x.seq) for x in rows if x.kind == "late"]
    assert set(got) == late and len(got) == len(late) and late


@pytest.mark.parametrize("scope", ["window", "key"])
def test_late_updates_stream(spark, scope):
    """L3: first and update emissions, with both tag scopes."""
    r, path, parts = disordered(spark, 8)
    out, _, _ = run(st.late_updates_stream(
        replay_stream(spark, path, r.schema), bound="1 hours", size="12 hours",
        allowance="30 hours", tag_scope=scope))
    want, state, seen = [], {}, set()

    def emit(key, end, n, first):
        if scope == "key":
            first = key not in seen
            seen.add(key)
        want.append((key, end, n, "first" if first else "update"))

    before = None
    for x, wm in cadence(parts, HOUR):
        if wm is not None and wm != before:
            for (k, end) in sorted(state, key=lambda w: (w[1], w[0])):
                if end <= wm and not state[k, end][1]:
                    emit(k, end, state[k, end][0], True)
                    state[k, end][1] = True
            before = wm
        end = _end(x.t, 12 * HOUR)
        if x.id < 0 or wm is not None and end + 30 * HOUR <= wm:
            continue
        s = state.setdefault((x.id, end), [0, False])
        s[0] += 1
        if wm is not None and end <= wm:
            emit(x.id, end, s[0], not s[1])
            s[1] = True
    for (k, end) in sorted(state, key=lambda w: (w[1], w[0])):
        if not state[k, end][1]:
            emit(k, end, state[k, end][0], True)
    got = [tuple(x) for x in out.filter("id >= 0").select(
        "id", F.unix_micros("end_ts"), "cnt", "tag").collect()]
    assert sorted(got) == sorted(want)
    assert sum(t[3] == "update" for t in want) > 10


def test_punctuated_watermark_drives_a_stateful_operator(spark):
    """T4: rows of other sensors arrive and are held; only a marker row moves time."""
    schema = "id string, ts timestamp, temperature double, seq long"
    path = tempfile.mkdtemp(prefix="kairo-replay-") + "/marked"
    t = lambda h: f"2024-01-01 {h:02d}:00:00"

    def feed(rows):
        df = spark.createDataFrame(rows, "id string, t string, temperature double, seq long")
        split_for_replay(df.select("id", F.col("t").cast("timestamp").alias("ts"), "temperature",
                                   "seq"), path, 1)

    feed([("sensor_2", t(20), 50.0, 1)])
    feed([("sensor_2", t(5), 10.0, 2), ("sensor_3", t(1), 9.0, 3)])      # older: still not lost
    s = replay_stream(spark, path, spark.createDataFrame([], schema).schema)
    ck = tempfile.mkdtemp(prefix="kairo-ck-")

    def once():
        q = (st.jump_alert_stream(s, 1.7, delay="60 seconds", clock=F.col("id") == "sensor_1")
             .writeStream.format("parquet").option("path", path + "-out")
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema(
            "id string, ts timestamp, seq long, temperature double, temp_diff double")
            .parquet(path + "-out").select("id", "seq", "temp_diff").collect())

    assert once() == []                          # time does not advance
    feed([("sensor_1", t(6), 0.0, 4)])
    assert once() == [("sensor_2", 2, 10.0), ("sensor_3", 3, 9.0)]
    feed([("sensor_1", t(21), 0.0, 5)])
    assert once() == [("sensor_2", 1, 40.0), ("sensor_2", 2, 10.0), ("sensor_3", 3, 9.0)]


# -- processing time (T6, X12): continuously triggered, ended by the test --------------

def wall_clock(spark, stream_of, feeds, done, limit=90):
    """Run with a half-second trigger; feed each part once the part before it has
    been processed, wait as told, and stop when ``done(rows)``."""
    schema = "id string, ts timestamp, temperature double, seq long, duration_ms long, et timestamp"
    path = tempfile.mkdtemp(prefix="kairo-replay-") + "/wall"
    empty = spark.createDataFrame([], schema)
    empty.write.parquet(path)
    s = replay_stream(spark, path, empty.schema)
    name = "w" + tempfile.mktemp(prefix="", dir="").replace("-", "_")[-10:]
    q = (stream_of(s).writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="kairo-ck-"))
         .trigger(processingTime="500 milliseconds").start())
    try:
        for rows, wait in feeds:
            before = sum(p["numInputRows"] for p in q.recentProgress)
            df = spark.createDataFrame(rows, "id string, t string, temperature double, seq long, "
                                             "duration_ms long").selectExpr(
                "id", "CAST(t AS TIMESTAMP) ts", "temperature", "seq", "duration_ms",
                "CAST(t AS TIMESTAMP) et")
            split_for_replay(df, path, 1)
            end = time.time() + limit
            while sum(p["numInputRows"] for p in q.recentProgress) < before + len(rows):
                assert q.isActive and time.time() < end, q.exception()
                time.sleep(0.2)
            time.sleep(wait)
        end = time.time() + limit
        while not done(out := [tuple(r) for r in spark.table(name).collect()]):
            assert q.isActive and time.time() < end, (q.exception(), out)
            time.sleep(0.5)
        return out
    finally:
        q.stop()


DAY = "2024-01-01 00:00:00"


def test_processing_time_gate(spark):
    """The gate opens for wall-clock time from the switch's micro-batch."""
    def stream_of(s):
        return st.gate_stream(s.filter("duration_ms IS NULL").drop("duration_ms", "et"),
                              s.filter("duration_ms IS NOT NULL").select("id", "ts", "duration_ms"),
                              processing_time=True)

    out = wall_clock(spark, stream_of, [
        ([("long", DAY, None, 0, 3_600_000), ("short", DAY, None, 0, 1000)], 3),
        ([("long", DAY, 1.0, 1, None), ("short", DAY, 2.0, 2, None), ("none", DAY, 3.0, 3, None),
          ("long", DAY, None, 4, None)], 0)], lambda out: len(out) >= 2)
    assert sorted((r[0], r[3]) for r in out) == [("long", 1), ("long", 4)]


def test_processing_time_rise(spark):
    """A rise that holds for a second of wall-clock time alerts; one that
    falls first does not; null readings change nothing."""
    def stream_of(s):
        return st.rise_alert_stream(s.drop("duration_ms", "et"), "1 second", processing_time=True)

    rows = [("up", DAY, 1.0, 1, None), ("up", DAY, 2.0, 2, None), ("up", DAY, None, 3, None),
            ("fall", DAY, 1.0, 1, None), ("fall", DAY, 2.0, 2, None), ("fall", DAY, 0.5, 3, None)]
    out = wall_clock(spark, stream_of, [(rows, 3)], lambda out: len(out) >= 1)
    assert [r[0] for r in out] == ["up"]


def test_periodic_late_report(spark):
    """L4: one self-renewing timer per key; every tick is emitted once."""
    def stream_of(s):
        return st.late_report_stream(s, bound="1 second", every="2 seconds")

    late = "2023-01-01 00:00:00"
    out = wall_clock(spark, stream_of, [
        ([("a", DAY, 1.0, 1, None)], 1),
        ([("a", late, 1.0, 2, None), ("a", late, 1.0, 3, None), ("b", DAY, 1.0, 4, None)], 5),
        ([("a", late, 1.0, 5, None)], 0)],
        lambda out: len(out) >= 4 and max(r[2] for r in out) == 3)
    assert {r[0] for r in out} == {"a"}
    ticks = [r[1] for r in out]
    assert len(set(ticks)) == len(ticks)
    gaps = {(b - a).total_seconds() for a, b in zip(sorted(ticks), sorted(ticks)[1:])}
    assert all(g % 2 == 0 and g > 0 for g in gaps)
    counts = [r[2] for r in sorted(out, key=lambda r: r[1])]
    assert counts == sorted(counts) and set(counts) == {2, 3}


def test_null_keys_are_a_key(spark):
    """A null key, times and readings that are null, in forms keyed by id and by bucket."""
    rows = [(None, "2024-01-01 01:00:00", 50.0, 1), (5, "2024-01-01 01:00:00", 60.0, 2),
            (None, "2024-01-01 02:00:00", 55.0, 3), (5, "2024-01-01 02:00:00", None, 4),
            (5, "2024-01-01 03:00:00", 99.0, 5), (0, "2024-01-01 03:00:00", 1.0, 6),
            (5, None, 7.0, 7), (-1, "2030-01-01 00:00:00", 5.0, 8), (2 ** 60 + 1, "2024-01-01 03:00:00", 9.0, 9)]
    df = spark.createDataFrame(rows, "id long, t string, temperature double, seq long").select(
        "id", F.col("t").cast("timestamp").alias("ts"), "temperature", "seq")
    path = tempfile.mkdtemp(prefix="kairo-replay-") + "/nulls"
    split_for_replay(df, path, 1)
    s = replay_stream(spark, path, df.schema)
    key = lambda d, *c: sorted(str(tuple(r)) for r in d.filter("id IS NULL OR id >= 0").select(*c).collect())
    out, _, _ = run(st.jump_alert_stream(s, delay="1 day"))
    cols = ["id", "ts", "seq", "temperature", "temp_diff"]
    known = df.filter("ts IS NOT NULL")
    assert key(out, *cols) == key(op.jump_alert(known), *cols) and out.count() >= 4
    hot, bucket = F.col("temperature") > 0, F.lit(1)
    out, _, _ = run(st.keyed_and_bucket_counts_stream(s, hot, bucket, delay="1 day"))
    cols = ["id", "ts", "seq", "bucket", "keyed_count", "bucket_count"]
    assert key(out, *cols) == key(op.keyed_and_bucket_counts(known, "id", ["ts", "seq"], hot, bucket), *cols)
