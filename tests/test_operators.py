"""Golden micro-fixtures and edge rows (FIXTURES.md §3, §4)."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kairo import operators as op
from kairo.functions.scalar import split_explode

T0 = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def readings(spark, rows):
    """rows: (id, seconds, temperature); seq = position."""
    return spark.createDataFrame(
        [(i, at(s), float(v), n) for n, (i, s, v) in enumerate(rows)],
        "id string, ts timestamp, temperature double, seq long")


@pytest.fixture(params=[False, True], ids=["direct", "chunked"])
def both_paths(request, spark):
    """Run a test with the direct window and with forced chunking."""
    from kairo.plans.scan import CHUNK_ROWS_CONF
    if request.param:
        spark.conf.set(CHUNK_ROWS_CONF, "1")
    yield
    spark.conf.unset(CHUNK_ROWS_CONF)


# ------------------------------------------------------------------ fixed rows
def test_rolling_sum_triples(spark, both_paths):
    df = spark.createDataFrame([(1, 2, 2, 0), (2, 3, 1, 1), (2, 2, 4, 2), (1, 5, 3, 3)],
                               "f0 int, f1 int, f2 int, seq long")
    out = op.rolling_sum(df, "f0", ["seq"], "f0", carry="first")
    got = [tuple(r)[:3] for r in out.orderBy("seq").collect()]
    assert got == [(1, 2, 2), (2, 3, 1), (4, 3, 1), (2, 2, 2)]


def test_threshold_table(spark):
    rows = [("sensor_1", 5.0), ("sensor_2", 0.9), ("sensor_3", 0.5), ("sensor_1", 1.2),
            ("sensor_3", 0.0)]
    th = spark.createDataFrame([(i, at(n), v, n) for n, (i, v) in enumerate(rows)],
                               "id string, ts timestamp, threshold double, seq long")
    got = {r["id"]: r["threshold"] for r in op.threshold_table(th).collect()}
    assert got == {"sensor_1": 1.2, "sensor_2": 0.9}


# ------------------------------------------------------------------ X1, X2
def test_jump_alert_first_reading_and_strict(spark, both_paths):
    # values exact in binary, so the difference equals the threshold exactly
    df = readings(spark, [("a", 0, 2.0), ("a", 1, 3.75), ("a", 2, 5.75), ("b", 0, 1.0)])
    got = [(r["id"], r["seq"]) for r in op.jump_alert(df, threshold=1.75).orderBy("seq").collect()]
    assert got == [("a", 0), ("a", 2)]            # diff == threshold: no alert; b: |1| < 1.75
    got = op.jump_alert(df, threshold=1.75, initial=None).collect()
    assert [r["seq"] for r in got] == [2]


def test_jump_alert_ttl_boundary(spark, both_paths):
    ttl = 3600
    df = readings(spark, [("a", 0, 10.0), ("a", ttl - 1, 10.0), ("a", 2 * ttl - 1, 10.0),
                          ("a", 2 * ttl, 10.0)])
    got = [r["seq"] for r in op.jump_alert_ttl(df, threshold=1.5, ttl_seconds=ttl)
           .orderBy("seq").collect()]
    assert got == [0, 2]                           # gap == ttl resets; gap < ttl does not


def test_alert_counter(spark):
    df = readings(spark, [("a", 0, 10.0), ("a", 1, 20.0), ("a", 2, 20.5)])
    alerts, obs = op.observe_count(op.jump_alert(df, threshold=1.7))
    assert alerts.count() == 2
    assert obs.get["alerts"] == 2


# ------------------------------------------------------------------ X3
def rise_fold(rows, hold_s):
    """Plain-Python step model of the rise alert (one key, sorted rows)."""
    out, prev, timer = [], None, None
    for t, v in rows:
        if timer is not None and timer <= t:
            out.append(timer)
            timer = None
        p = prev if prev is not None else 0.0
        prev = v
        if p == 0.0 or v < p:
            timer = None
        elif v > p and timer is None:
            timer = t + hold_s
    return out, timer


def test_rise_alert_edges(spark, both_paths):
    df = readings(spark, [
        ("a", 0.0, 1.0), ("a", 0.1, 2.0), ("a", 0.5, 2.0),   # rise arms 1.1, equal keeps
        ("a", 1.2, 3.0),                                      # fires 1.1, re-arms 2.2
        ("a", 1.5, 2.5),                                      # fall cancels
        ("a", 2.0, 3.0),                                      # arms 3.0: pending at end
        ("b", 0.0, 0.0), ("b", 0.1, 1.0),                     # previous 0.0: unset
        ("b", 0.2, 2.0), ("b", 1.2, 2.0), ("b", 1.3, 2.0)])   # arms 1.2, fires at 1.2
    got = sorted((r["id"], r["ts"]) for r in op.rise_alert(df, hold="1 second").collect())
    assert got == [("a", at(1.1)), ("b", at(1.2))]


def test_rise_alert_matches_step_model(spark):
    from conftest import SF0001
    from kairo.sources.tables import readings as to_readings
    ev = to_readings(spark.read.parquet(f"{SF0001}/events.parquet"))
    got = sorted((r["id"], r["ts"]) for r in op.rise_alert(ev, hold="2 hours").collect())
    rows = ev.select("id", "ts", "seq", "temperature").collect()
    end = max(r["ts"] for r in rows)
    want = []
    for key in sorted({r["id"] for r in rows}):
        mine = sorted((r["ts"], r["seq"], r["temperature"]) for r in rows if r["id"] == key)
        fired, pending = rise_fold([(t, v) for t, _, v in mine], timedelta(hours=2))
        want += [(key, t) for t in fired]
        if pending is not None and pending <= end:
            want.append((key, pending))
    assert got == sorted(want)


# ------------------------------------------------------------------ J1–J3
def test_gate_boundaries(spark, both_paths):
    sw = spark.createDataFrame([("s", at(10), 10_000), ("s", at(15), 2_000), ("s", at(18), 10_000)],
                               "id string, ts timestamp, duration_ms long").withColumn(
                                   "seq", F.lit(0).cast("long"))
    r = readings(spark, [("s", 9.999, 1), ("s", 10, 1), ("s", 19.999, 1), ("s", 25, 1),
                         ("s", 28, 1), ("t", 12, 1)])
    got = [r_["seq"] for r_ in op.gate(r, sw).orderBy("seq").collect()]
    assert got == [1, 2, 3]                        # [10,20) ∪ [18,28); t has no switch


def test_fire_risk_levels(spark, both_paths):
    lv = spark.createDataFrame([(at(5), "HIGH", 100), (at(20), "LOW", 101)],
                               "ts timestamp, level string, seq long")
    r = readings(spark, [("a", 1, 150), ("a", 5, 100.5), ("b", 6, 100.0), ("b", 10, 101),
                         ("a", 20, 150)])
    got = sorted(r_["ts"] for r_ in op.fire_risk(r, lv).collect())
    assert got == [at(5), at(10)]                  # LOW before 5; exactly 100 does not alert


def test_threshold_alert_removed_key_still_moves_last(spark, both_paths):
    th = spark.createDataFrame(
        [("s3", at(1), 0.5, 100), ("s3", at(2), 0.0, 101), ("s3", at(20), 0.5, 102)],
        "id string, ts timestamp, threshold double, seq long")
    r = readings(spark, [("s3", 10, 10.0), ("s3", 30, 10.2), ("s3", 40, 11.0)])
    got = [r_["seq"] for r_ in op.threshold_alert(r, th).collect()]
    assert got == [2]                              # 10.2 vs moved last 10.0: no alert


# ------------------------------------------------------------------ P5, W1–W3, K6
def test_split_keeps_empty_parts(spark):
    df = spark.createDataFrame([("_a__b_",)], "s string")
    got = [r["part"] for r in split_explode(df, "s", "_").orderBy("pos").collect()]
    assert got == ["", "a", "", "b", ""]


def test_window_edge_belongs_to_next(spark):
    df = readings(spark, [("a", 10, 1.0), ("a", 9.999, 2.0)])
    got = sorted((r["end_ts"], r["cnt"]) for r in op.window_count(df, size="10 seconds").collect())
    assert got == [(at(10), 1), (at(20), 1)]


def test_early_fire(spark):
    df = readings(spark, [("a", 0.5, 1.0), ("a", 2.5, 3.0)])
    out = op.early_fire(df, size="1 minute", pane="1 second").orderBy("fire_ts").collect()
    assert [r["fire_ts"] for r in out[:4]] == [at(1), at(2), at(3), at(4)]
    assert [r["temperature"] for r in out[:4]] == [1.0, 1.0, 3.0, 3.0]
    assert len(out) == 60 and out[-1]["final"] and out[-1]["fire_ts"] == at(60)


def test_argmax_tie_newer_wins(spark, both_paths):
    df = readings(spark, [("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 4.0)])
    got = [r["max_seq"] for r in op.rolling_argmax(df, "id", ["ts", "seq"], "temperature")
           .orderBy("seq").collect()]
    assert got == [0, 1, 1]


def test_freezing_monitor_boundary(spark):
    df = readings(spark, [("a", 1, 32.0), ("a", 2, 31.9)])
    out = op.freezing_monitor(df)
    side = out.filter("kind = 'side'").collect()
    assert out.filter("kind = 'main'").count() == 2
    assert [(r["seq"], r["message"]) for r in side] == [(1, "Freezing Alarm for a")]


def test_running_and_bucket_counts(spark, both_paths):
    df = readings(spark, [("a", 1, 130), ("b", 2, 121), ("a", 3, 100), ("a", 4, 125)])
    out = op.keyed_and_bucket_counts(df, "id", ["ts", "seq"], F.col("temperature") > 120,
                                     F.lit(0)).orderBy("seq").collect()
    assert [(r["keyed_count"], r["bucket_count"]) for r in out] == [(1, 1), (1, 2), (2, 3)]


# ------------------------------------------------------------------ L1–L4
def late_rows(spark, ets):
    return spark.createDataFrame([("a", at(e), 1.0, n, at(e)) for n, e in enumerate(ets)],
                                 "id string, ts timestamp, temperature double, seq long, et timestamp")


def test_watermark_boundary(spark, both_paths):
    df = late_rows(spark, [100, 95, 94.999])
    got = {r["seq"]: r["late"] for r in op.flag_late(df, bound_s=5).collect()}
    assert got == {0: False, 1: False, 2: True}   # et == wm is on time


def test_late_updates_allowance(spark, both_paths):
    df = late_rows(spark, [5, 12, 3, 20, 4])
    out = op.late_updates(df, bound_s=0, size="10 seconds", allowance_s=5)
    got = sorted((r["end_ts"], r["cnt"], r["tag"]) for r in out.collect())
    assert got == [(at(10), 1, "first"), (at(10), 2, "update"), (at(20), 1, "first"),
                   (at(30), 1, "first")]
    main, late = op.late_window_split(df, bound_s=0, size="10 seconds")
    assert sorted(r["seq"] for r in late.collect()) == [2, 4]
    assert sorted(r["late_count"] for r in op.late_counts(df, bound_s=0).collect()) == [2]


# ------------------------------------------------------------------ null readings, repeated seq
def test_rolling_sum_keeps_a_null_first_value(spark, both_paths):
    df = spark.createDataFrame([("a", 1.0, None, 0), ("a", 2.0, "x", 1), ("b", 5.0, "y", 2)],
                               "k string, v double, note string, seq long")
    out = op.rolling_sum(df, "k", ["seq"], "v").orderBy("seq").collect()
    assert [(r["v"], r["note"]) for r in out] == [(1.0, None), (3.0, None), (5.0, "y")]


def test_jump_alert_null_readings(spark, both_paths):
    df = spark.createDataFrame(
        [("a", at(0), 1.0, 0), ("a", at(1), None, 1), ("a", at(2), 9.0, 2), ("a", at(3), 1.0, 3)],
        "id string, ts timestamp, temperature double, seq long")
    assert [r["seq"] for r in op.jump_alert(df, threshold=1.75).collect()] == [3]
    assert [r["seq"] for r in op.jump_alert_ttl(df, threshold=1.75).collect()] == [3]


def test_rise_alert_seq_may_repeat_across_keys(spark, both_paths):
    rows = [(0.0, 1.0), (0.1, 2.0), (1.2, 3.0), (2.5, 4.0), (2.6, 1.0), (3.0, 2.0), (9.0, 3.0)]
    same = spark.createDataFrame([(k, at(s), v, n) for k in ("a", "b") for n, (s, v) in enumerate(rows)],
                                 "id string, ts timestamp, temperature double, seq long")
    own = spark.createDataFrame([(k, at(s), v, 100 * i + n) for i, k in enumerate(("a", "b"))
                                 for n, (s, v) in enumerate(rows)],
                                "id string, ts timestamp, temperature double, seq long")
    got = [sorted((r["id"], r["ts"], r["armed_seq"] % 100) for r in op.rise_alert(d).collect())
           for d in (same, own)]
    assert got[0] == got[1] and got[0]


# ------------------------------------------------------------------ one pass
def _scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_early_fire_pane_need_not_divide_the_window(spark):
    df = readings(spark, [("a", 10, 1.0), ("a", 50, 3.0), ("a", 70, 2.0)])
    got = [(r["end_ts"], r["fire_ts"], r["temperature"], r["final"]) for r in
           op.early_fire(df, size="1 minute", pane="45 seconds").orderBy("end_ts", "fire_ts").collect()]
    # panes end at multiples of 45 s from the epoch: 0:45, 1:30; the first window's second
    # pane ends after the window, so it shows in the final row only
    assert got == [(at(60), at(45), 1.0, False), (at(60), at(60), 3.0, True),
                   (at(120), at(90), 2.0, False), (at(120), at(120), 2.0, True)]


def test_route_and_early_fire_read_once(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("user_id").alias("id"), "ts", F.col("value").alias("temperature"),
        F.col("event_id").alias("seq"))
    assert _scans(op.freezing_monitor(ev)) == 1
    assert _scans(op.early_fire(ev, size="1 day", pane="1 hour")) == 1


# ------------------------------------------------------------------ scalar helpers
def test_scalar_helpers(spark):
    from kairo.functions.scalar import abs_diff, bucket_start, message, pair_max, pair_min, tuple_of
    df = spark.createDataFrame([(3.0, 5.0, at(7), "k"), (2.0, -1.0, at(-1), "m")],
                               "a double, b double, ts timestamp, id string")
    got = df.select(abs_diff("a", "b"), pair_max("a", "b"), pair_min("a", "b"),
                    tuple_of("id", "a").alias("t"), message("%s!", "id"),
                    bucket_start("ts", "5 seconds")).collect()
    assert tuple(got[0]) == (2.0, 5.0, 3.0, ("k", 3.0), "k!", at(5))
    assert tuple(got[1]) == (3.0, 2.0, -1.0, ("m", 2.0), "m!", at(-5))
