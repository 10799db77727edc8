"""Registered queries on the driver's ``events`` table and their SQL oracles.

``events`` is read as a sensor stream: ``user_id`` → id, ``value`` →
temperature, ``event_id`` → seq (arrival order); event types pick the
control rows.  Every query reads the whole table.  Each ``QUERIES[name]``
takes ``(spark, sf_dir)`` and returns a DataFrame; ``ORACLE[name]`` is
DuckDB SQL over the same table giving the same rows and column names
(averages and sums rounded to 6 decimals on both sides).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairo import operators as op
from kairo.functions.scalar import split_explode
from kairo.functions.windowing import assign_windows, fixed_assigner
from kairo.sources.tables import (
    levels_from_events, read_table, readings, switches_from_events,
    thresholds_from_events,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000


def with_disorder(df: DataFrame, *, seq: str = "seq", ts: str = "ts",
                  out: str = "et", multiplier: int = 48271,
                  spread_s: int = 25200) -> DataFrame:
    """Deterministic event-time disorder used by the late-data queries:
    ``et = ts + ((seq * multiplier) % spread_s) seconds``.  Arrival order
    stays ``seq``, so rows now arrive out of event-time order."""
    shift = (F.col(seq) * F.lit(multiplier)) % F.lit(spread_s)
    return df.withColumn(out, F.col(ts) + F.make_dt_interval(secs=shift.cast("decimal(18,6)")))


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(_events(spark, sf_dir))


def _bucket_sql(size_us: int, col: str = "ts", end: bool = True) -> str:
    k = 1 if end else 0
    return f"make_timestamp((epoch_us({col}) // {size_us} + {k}) * {size_us})"


# ---------------------------------------------------------------- P1, P2, P5
@register("filter_explode", """
SELECT seq, unnest(range(0, len(parts))) AS pos, unnest(parts) AS part
FROM (SELECT event_id AS seq, string_split('user_' || CAST(user_id AS VARCHAR), '_') AS parts
      FROM events WHERE value >= 25) t
""")
def q_filter_explode(spark, sf_dir):
    r = _readings(spark, sf_dir).filter(F.col("temperature") >= 25)           # P1
    ids = r.select("seq", F.concat(F.lit("user_"), F.col("id").cast("string")).alias("sid"))  # P2
    out = split_explode(ids, "sid", "_", out="part", pos="pos")              # P5
    return out.select("seq", F.col("pos").cast("long").alias("pos"), "part")


# ---------------------------------------------------------------- A3–A8, A13, W1, W2
@register("f_to_c_window_avg", f"""
SELECT user_id AS id, {_bucket_sql(DAY_US)} AS end_ts,
       round(avg((value - 32) * (5.0::DOUBLE / 9.0::DOUBLE)), 6) AS temperature
FROM events GROUP BY ALL
""")
def q_f_to_c_window_avg(spark, sf_dir):
    out = op.window_avg_celsius(_readings(spark, sf_dir), size="1 day")
    return out.withColumn("temperature", F.round("temperature", 6))


@register("window_avg", f"""
SELECT user_id AS id, {_bucket_sql(6 * HOUR_US)} AS end_ts, round(avg(value), 6) AS temperature
FROM events GROUP BY ALL
""")
def q_window_avg(spark, sf_dir):
    out = op.window_avg(_readings(spark, sf_dir), size="6 hours")
    return out.withColumn("temperature", F.round("temperature", 6))


@register("window_min", f"""
SELECT user_id AS id, {_bucket_sql(6 * HOUR_US)} AS end_ts, min(value) AS temperature
FROM events GROUP BY ALL
""")
def q_window_min(spark, sf_dir):
    return op.window_min(_readings(spark, sf_dir), size="6 hours")


@register("window_min_max", f"""
SELECT user_id AS id, min(value) AS min, max(value) AS max, {_bucket_sql(DAY_US)} AS end_ts
FROM events GROUP BY user_id, end_ts
""")
def q_window_min_max(spark, sf_dir):
    return op.window_min_max(_readings(spark, sf_dir), size="1 day").select(
        "id", "min", "max", "end_ts")


@register("window_count", f"""
SELECT user_id AS id, {_bucket_sql(DAY_US)} AS end_ts, count(*) AS cnt
FROM events GROUP BY ALL
""")
def q_window_count(spark, sf_dir):
    return op.window_count(_readings(spark, sf_dir), size="1 day")


@register("window_max_elementwise", f"""
SELECT user_id AS id, {_bucket_sql(DAY_US)} AS end_ts, max(ts) AS ts, max(value) AS temperature
FROM events GROUP BY user_id, end_ts
""")
def q_window_max_elementwise(spark, sf_dir):
    return op.window_elementwise_max(_readings(spark, sf_dir), size="1 day")


@register("window_30", f"""
SELECT user_id AS id, {_bucket_sql(1800_000_000, end=False)} AS start_ts,
       {_bucket_sql(1800_000_000)} AS end_ts, count(*) AS cnt
FROM events GROUP BY ALL
""")
def q_window_30(spark, sf_dir):
    r = assign_windows(_readings(spark, sf_dir), "ts", fixed_assigner("30 minutes"), out="w")
    return op.window_agg(r, "id", "ts", "30 minutes", {"cnt": F.count(F.lit(1))},
                         start="start_ts", window=F.col("w"))


@register("early_fire_max", f"""
WITH p AS (
  SELECT user_id AS id, {_bucket_sql(DAY_US)} AS w_end, {_bucket_sql(HOUR_US)} AS p_end,
         max(ts) AS mt, max(value) AS mv
  FROM events GROUP BY ALL),
r AS (
  SELECT id, w_end, p_end,
         max(mt) OVER (PARTITION BY id, w_end ORDER BY p_end) AS ts,
         max(mv) OVER (PARTITION BY id, w_end ORDER BY p_end) AS temperature,
         lead(p_end) OVER (PARTITION BY id, w_end ORDER BY p_end) AS nxt
  FROM p)
SELECT id, w_end AS end_ts,
       unnest(generate_series(p_end, least(coalesce(nxt, w_end), w_end) - INTERVAL 1 HOUR,
                              INTERVAL 1 HOUR)) AS fire_ts,
       ts, temperature, false AS final
FROM r WHERE p_end < w_end
UNION ALL
SELECT id, w_end AS end_ts, w_end AS fire_ts, ts, temperature, true AS final
FROM r WHERE nxt IS NULL
""")
def q_early_fire_max(spark, sf_dir):
    return op.early_fire(_readings(spark, sf_dir), size="1 day", pane="1 hour")


# ---------------------------------------------------------------- A1, A2, A9–A11
@register("rolling_sum", """
SELECT user_id AS id, ts, event_id AS seq,
       round(sum(value) OVER w, 6) AS temperature,
       first_value(event_type) OVER w AS event_type
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def q_rolling_sum(spark, sf_dir):
    r = _readings(spark, sf_dir)
    out = op.rolling_sum(r, "id", ["ts", "seq"], "temperature", carry="first")
    return out.withColumn("temperature", F.round("temperature", 6))


@register("rolling_argmax", """
SELECT id, ts, seq, m.v AS max_temperature, m.t AS max_ts, m.s AS max_seq,
       m.e AS max_event_type
FROM (SELECT user_id AS id, ts, event_id AS seq,
             max({'v': value, 't': ts, 's': event_id, 'e': event_type}) OVER
               (PARTITION BY user_id ORDER BY ts, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m
      FROM events) q
""")
def q_rolling_argmax(spark, sf_dir):
    return op.rolling_argmax(_readings(spark, sf_dir), "id", ["ts", "seq"], "temperature")


@register("running_count", """
SELECT user_id AS id, ts, event_id AS seq,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS keyed_count
FROM events WHERE value > 120
""")
def q_running_count(spark, sf_dir):
    r = _readings(spark, sf_dir)
    return op.running_count(r, "id", ["ts", "seq"], F.col("temperature") > 120).select(
        "id", "ts", "seq", "keyed_count")


@register("keyed_bucket_count", """
SELECT user_id AS id, ts, event_id AS seq, CAST(user_id % 8 AS INTEGER) AS bucket,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS keyed_count,
       row_number() OVER (PARTITION BY user_id % 8 ORDER BY ts, event_id) AS bucket_count
FROM events WHERE value > 10
""")
def q_keyed_bucket_count(spark, sf_dir):
    r = _readings(spark, sf_dir)
    out = op.keyed_and_bucket_counts(r, "id", ["ts", "seq"], F.col("temperature") > 10,
                                     F.pmod(F.col("id"), F.lit(8)).cast("int"))
    return out.select("id", "ts", "seq", "bucket", "keyed_count", "bucket_count")


@register("bucket_count", """
SELECT CAST(user_id % 8 AS INTEGER) AS bucket, ts, event_id AS seq,
       row_number() OVER (PARTITION BY user_id % 8 ORDER BY ts, event_id) AS count
FROM events WHERE value > 120
""")
def q_bucket_count(spark, sf_dir):
    r = _readings(spark, sf_dir)
    return op.bucket_counts(r, ["ts", "seq"], F.col("temperature") > 120,
                            F.pmod(F.col("id"), F.lit(8)).cast("int"))


# ---------------------------------------------------------------- K6, X6
@register("side_outputs", """
SELECT 'main' AS kind, user_id AS id, ts, value AS temperature, event_id AS seq,
       event_type, NULL::VARCHAR AS message
FROM events
UNION ALL
SELECT 'side' AS kind, user_id AS id, ts, NULL::DOUBLE AS temperature, event_id AS seq,
       NULL::VARCHAR AS event_type, 'Freezing Alarm for ' || CAST(user_id AS VARCHAR) AS message
FROM events WHERE value < 32
""")
def q_side_outputs(spark, sf_dir):
    return op.freezing_monitor(_readings(spark, sf_dir)).select(
        "kind", "id", "ts", "temperature", "seq", "event_type", "message")


# ---------------------------------------------------------------- X1, X2, A12
@register("jump_alert", """
SELECT id, ts, seq, temperature, temp_diff FROM (
  SELECT user_id AS id, ts, event_id AS seq, value AS temperature,
         abs(value - lag(value, 1, 0.0) OVER (PARTITION BY user_id ORDER BY ts, event_id))
           AS temp_diff
  FROM events) q
WHERE temp_diff > 1.7
""")
def q_jump_alert(spark, sf_dir):
    return op.jump_alert(_readings(spark, sf_dir), threshold=1.7)


_TTL_SQL = """
SELECT id, ts, seq, temperature, temp_diff FROM (
  SELECT user_id AS id, ts, event_id AS seq, value AS temperature,
         abs(value - CASE WHEN pts IS NULL OR ts >= pts + INTERVAL 1 DAY THEN 0.0 ELSE pv END)
           AS temp_diff
  FROM (SELECT *, lag(value) OVER w AS pv, lag(ts) OVER w AS pts FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) a) q
WHERE temp_diff > 1.5
"""


@register("jump_alert_ttl", _TTL_SQL)
def q_jump_alert_ttl(spark, sf_dir):
    return op.jump_alert_ttl(_readings(spark, sf_dir), threshold=1.5, ttl_seconds=86400)


@register("alert_counter", f"SELECT count(*) AS alerts FROM ({_TTL_SQL}) x")
def q_alert_counter(spark, sf_dir):
    alerts, _obs = op.observe_count(
        op.jump_alert_ttl(_readings(spark, sf_dir), threshold=1.5, ttl_seconds=86400))
    return alerts.agg(F.count(F.lit(1)).alias("alerts"))


# ---------------------------------------------------------------- X3
_RISE_SQL = """
WITH RECURSIVE b AS (
  SELECT user_id AS id, ts, event_id AS seq, value AS v,
         lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
c AS (
  SELECT *, CASE WHEN p IS NULL OR p = 0.0 OR v < p THEN 'F' WHEN v > p THEN 'R' ELSE 'E' END AS cls
  FROM b),
s AS (
  SELECT *,
    sum(CASE WHEN cls = 'F' THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY ts, seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg,
    min(CASE WHEN cls = 'F' THEN ts END) OVER (PARTITION BY id ORDER BY ts, seq
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_f
  FROM c),
r AS (SELECT id, seg, ts, seq, next_f, ts + INTERVAL 1 DAY AS deadline FROM s WHERE cls = 'R'),
nx AS (SELECT a.seq, b.seq AS nxt FROM r a ASOF LEFT JOIN r b
       ON a.id = b.id AND a.seg = b.seg AND a.deadline <= b.ts),
starts AS (SELECT arg_min(seq, (ts, seq)) AS seq FROM r GROUP BY id, seg),
chain(seq) AS (
  SELECT seq FROM starts
  UNION ALL
  SELECT nx.nxt FROM chain JOIN nx ON chain.seq = nx.seq WHERE nx.nxt IS NOT NULL)
SELECT r.id, r.deadline AS ts, r.seq AS armed_seq,
       format('Temperature of sensor ''{}'' monotonically increased 1 day.', r.id) AS message
FROM chain JOIN r ON chain.seq = r.seq JOIN nx ON nx.seq = r.seq
WHERE nx.nxt IS NOT NULL
   OR (r.next_f IS NOT NULL AND r.next_f >= r.deadline)
   OR (r.next_f IS NULL AND r.deadline <= (SELECT max(ts) FROM events))
"""


@register("rise_alert", _RISE_SQL)
def q_rise_alert(spark, sf_dir):
    return op.rise_alert(_readings(spark, sf_dir), hold="1 day")


# ---------------------------------------------------------------- J1
@register("gate", """
SELECT r.user_id AS id, r.ts, r.value AS temperature, r.event_id AS seq, r.event_type
FROM events r
WHERE r.event_type <> 'signup'
  AND EXISTS (SELECT 1 FROM events s
              WHERE s.event_type = 'signup' AND s.user_id = r.user_id
                AND s.ts <= r.ts AND r.ts < s.ts + INTERVAL 2 DAY)
""")
def q_gate(spark, sf_dir):
    ev = _events(spark, sf_dir)
    r = readings(ev, event_type=F.col("event_type") != "signup")
    sw = switches_from_events(ev, "signup", 2 * 86_400_000)
    return op.gate(r, sw)


# ---------------------------------------------------------------- J2, X5
_LEVELS_SQL = """
WITH lv AS (SELECT ts, CASE WHEN value > 80 THEN 'HIGH' ELSE 'LOW' END AS level
            FROM events WHERE event_type = 'error'),
     rd AS (SELECT user_id AS id, ts, value AS temperature, event_id AS seq, event_type
            FROM events WHERE event_type <> 'error')
"""


@register("latest_level", _LEVELS_SQL + """
SELECT rd.id, rd.ts, rd.temperature, rd.seq, rd.event_type, coalesce(lv.level, 'LOW') AS level
FROM rd ASOF LEFT JOIN lv ON rd.ts >= lv.ts
""")
def q_latest_level(spark, sf_dir):
    ev = _events(spark, sf_dir)
    r = readings(ev, event_type=F.col("event_type") != "error")
    return op.latest_level(r, levels_from_events(ev, "error", 80.0))


@register("fire_risk", _LEVELS_SQL + """
SELECT rd.id, rd.ts, 'Risk of fire!' AS message
FROM rd ASOF LEFT JOIN lv ON rd.ts >= lv.ts
WHERE coalesce(lv.level, 'LOW') = 'HIGH' AND rd.temperature > 100
""")
def q_fire_risk(spark, sf_dir):
    ev = _events(spark, sf_dir)
    r = readings(ev, event_type=F.col("event_type") != "error")
    return op.fire_risk(r, levels_from_events(ev, "error", 80.0), above=100.0)


# ---------------------------------------------------------------- J3, X4
@register("threshold_alert", """
WITH u AS (
  SELECT user_id AS id, ts, event_id AS seq, 0 AS src,
         CASE WHEN event_id % 5 = 0 THEN 0.0 ELSE value END AS thr, NULL::DOUBLE AS rv
  FROM events WHERE event_type = 'purchase'
  UNION ALL
  SELECT user_id, ts, event_id, 1, NULL::DOUBLE, value
  FROM events WHERE event_type <> 'purchase'),
s AS (
  SELECT *, last_value(thr IGNORE NULLS) OVER w AS cur,
         last_value(rv IGNORE NULLS) OVER (PARTITION BY id ORDER BY ts, src, seq
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM u WINDOW w AS (PARTITION BY id ORDER BY ts, src, seq
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT id, ts, seq, rv AS temperature, abs(rv - coalesce(prev, 0.0)) AS temp_diff
FROM s
WHERE src = 1 AND cur IS NOT NULL AND cur <> 0.0 AND abs(rv - coalesce(prev, 0.0)) > cur
""")
def q_threshold_alert(spark, sf_dir):
    ev = _events(spark, sf_dir)
    r = readings(ev, event_type=F.col("event_type") != "purchase")
    return op.threshold_alert(r, thresholds_from_events(ev, "purchase", 5))


@register("threshold_state", """
SELECT id, threshold FROM (
  SELECT user_id AS id, arg_max(CASE WHEN event_id % 5 = 0 THEN 0.0 ELSE value END,
                                (ts, event_id)) AS threshold
  FROM events WHERE event_type = 'purchase' GROUP BY user_id) q
WHERE threshold <> 0.0
""")
def q_threshold_state(spark, sf_dir):
    return op.threshold_table(thresholds_from_events(_events(spark, sf_dir), "purchase", 5))


# ---------------------------------------------------------------- L1–L4
_ET = "ts + to_seconds((event_id * 48271) % 25200)"
_WM_SQL = f"""
WITH d AS (SELECT user_id AS id, ts, {_ET} AS et, value AS temperature, event_id AS seq
           FROM events),
w AS (SELECT *, max(et) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - INTERVAL 5 HOUR AS wm,
             {_bucket_sql(HOUR_US, 'et', end=False)} AS ws,
             {_bucket_sql(HOUR_US, 'et')} AS end_ts
      FROM d)
"""
_LATE_BOUND_S = 5 * 3600


def _disordered(spark, sf_dir):
    r = _readings(spark, sf_dir).drop("event_type")
    return with_disorder(r, seq="seq", ts="ts", out="et")


@register("late_rows", _WM_SQL + """
SELECT id, ts, temperature, seq, et FROM w WHERE et < wm
""")
def q_late_rows(spark, sf_dir):
    return op.late_rows(_disordered(spark, sf_dir), bound_s=_LATE_BOUND_S).select(
        "id", "ts", "temperature", "seq", "et")


@register("late_counts", _WM_SQL + """
SELECT id, count(*) AS late_count FROM w WHERE et < wm GROUP BY id
""")
def q_late_counts(spark, sf_dir):
    return op.late_counts(_disordered(spark, sf_dir), bound_s=_LATE_BOUND_S)


@register("late_window_counts", _WM_SQL + """
SELECT id, end_ts, count(*) AS cnt FROM w WHERE wm IS NULL OR end_ts > wm GROUP BY id, end_ts
""")
def q_late_window_counts(spark, sf_dir):
    main, _late = op.late_window_split(_disordered(spark, sf_dir), bound_s=_LATE_BOUND_S,
                                       size="1 hour")
    return main


@register("late_window_rows", _WM_SQL + """
SELECT id, ts, temperature, seq, et FROM w WHERE end_ts <= wm
""")
def q_late_window_rows(spark, sf_dir):
    _main, late = op.late_window_split(_disordered(spark, sf_dir), bound_s=_LATE_BOUND_S,
                                       size="1 hour")
    return late.select("id", "ts", "temperature", "seq", "et")


@register("late_updates", _WM_SQL + """
, k AS (SELECT *, coalesce(end_ts <= wm, false) AS fired FROM w
        WHERE NOT coalesce(end_ts + INTERVAL 1 HOUR <= wm, false)),
r AS (SELECT *, count(*) OVER (PARTITION BY id, ws ORDER BY seq
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt,
             count(CASE WHEN NOT fired THEN 1 END) OVER (PARTITION BY id, ws ORDER BY seq
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ontime
      FROM k)
SELECT id, end_ts, count(*) AS cnt, 'first' AS tag FROM k WHERE NOT fired GROUP BY id, end_ts
UNION ALL
SELECT id, end_ts, cnt, CASE WHEN ontime = 0 AND cnt = 1 THEN 'first' ELSE 'update' END AS tag
FROM r WHERE fired
""")
def q_late_updates(spark, sf_dir):
    return op.late_updates(_disordered(spark, sf_dir), bound_s=_LATE_BOUND_S, size="1 hour",
                           allowance_s=3600)


@register("late_updates_by_key", _WM_SQL + """
, k AS (SELECT *, coalesce(end_ts <= wm, false) AS fired FROM w
        WHERE NOT coalesce(end_ts + INTERVAL 1 HOUR <= wm, false)),
r AS (SELECT *, count(*) OVER (PARTITION BY id, ws ORDER BY seq
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM k),
e AS (SELECT id, end_ts, count(*) AS cnt, end_ts AS pos, -1 AS k FROM k WHERE NOT fired
      GROUP BY id, end_ts
      UNION ALL SELECT id, end_ts, cnt, wm, seq FROM r WHERE fired)
SELECT id, end_ts, cnt, CASE WHEN row_number() OVER (PARTITION BY id ORDER BY pos, k) = 1
                             THEN 'first' ELSE 'update' END AS tag FROM e
""")
def q_late_updates_by_key(spark, sf_dir):
    return op.late_updates(_disordered(spark, sf_dir), bound_s=_LATE_BOUND_S, size="1 hour",
                           allowance_s=3600, tag_scope="key")
