"""Control-stream joins (J1–J3) and the alerts built on them.

The reference connects a reading stream with a control stream and keeps the
control value in state.  In batch this is an *as-of* relation: each reading
sees the control value last set at or before its time.  Instead of a range
join (which pairs every reading with every control row of its key), readings
and control rows are unioned with a source tag and one prefix scan carries
the latest control value forward — a single exchange, no pairs, and hot keys
are scanned in chunks.  Control rows sort before readings of the same time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairo.functions.scalar import abs_diff
from kairo.plans.scan import Agg, prefix_scan
from kairo.schema import LEVEL_HIGH, LEVEL_LOW

_CONTROL, _READING = 0, 1


def _tagged_union(readings: DataFrame, control: DataFrame, cols: dict) -> DataFrame:
    r = readings.withColumn("_src", F.lit(_READING))
    c = control.withColumn("_src", F.lit(_CONTROL))
    for name, dtype in cols.items():
        if name not in r.columns:
            r = r.withColumn(name, F.lit(None).cast(dtype))
    return r.unionByName(c, allowMissingColumns=True)


def gate(readings: DataFrame, switches: DataFrame, *, key: str = "id", ts: str = "ts",
         seq: str = "seq", duration_ms: str = "duration_ms") -> DataFrame:
    """J1 (keyed switch gate): a switch ``(id, ts, d)`` opens the key's gate
    for ``[ts, ts + d)``; a longer later switch extends it, a shorter one
    changes nothing; readings pass only while the gate is open.

    The gate is open at ``t`` iff the running maximum of ``switch_ts + d``
    over the key's switches at or before ``t`` is ``> t``.  Output: the
    passing readings, unchanged.
    """
    sw = switches.select(
        F.col(key), F.col(ts),
        (F.col(ts) + F.make_dt_interval(secs=(F.col(duration_ms) / 1000).cast("decimal(18,6)"))
         ).alias("_gate_end"))
    u = _tagged_union(readings, sw, {"_gate_end": sw.schema["_gate_end"].dataType})
    s = prefix_scan(u, [key], [ts, "_src", seq], [Agg("_open_until", "max", "_gate_end")])
    return (s.filter((F.col("_src") == _READING) & (F.col(ts) < F.col("_open_until")))
             .select(*readings.columns))


def latest_level(readings: DataFrame, levels: DataFrame, *, ts: str = "ts",
                 seq: str = "seq", level: str = "level",
                 initial: str = LEVEL_LOW) -> DataFrame:
    """J2 (latest control value, un-keyed): every reading with the level
    last received at or before its time (``initial`` before the first).

    The control stream has no key, so the scan is global: the union is cut
    into ordered chunks (``kairo.plans.scan``) instead of broadcasting a
    control table that grows with the data.
    """
    lv = levels.select(F.col(ts), F.col(seq), F.col(level).alias("_lvl"))
    u = _tagged_union(readings, lv, {"_lvl": "string"})
    s = prefix_scan(u, [], [ts, "_src", seq], [Agg("_cur", "last", "_lvl")])
    return (s.filter(F.col("_src") == _READING)
             .withColumn(level, F.coalesce(F.col("_cur"), F.lit(initial)))
             .select(*readings.columns, level))


def fire_risk(readings: DataFrame, levels: DataFrame, *, key: str = "id", ts: str = "ts",
              seq: str = "seq", value: str = "temperature",
              above: float = 100.0) -> DataFrame:
    """``Risk of fire!`` when the current smoke level is HIGH and the
    reading is above ``above``.  Output ``(id, ts, message)``."""
    lv = latest_level(readings, levels, ts=ts, seq=seq)
    return (lv.filter((F.col("level") == LEVEL_HIGH) & (F.col(value) > F.lit(above)))
              .select(F.col(key), F.col(ts), F.lit("Risk of fire!").alias("message")))


def threshold_alert(readings: DataFrame, thresholds: DataFrame, *, key: str = "id",
                    ts: str = "ts", seq: str = "seq", value: str = "temperature",
                    threshold: str = "threshold", initial: float = 0.0) -> DataFrame:
    """J3 + X4: per-key threshold table with delete, and a jump alert
    against it.

    A threshold update sets the key's threshold; ``0.0`` removes it.  A
    reading is checked only while its key has a threshold:
    ``|value - previous reading of the key| > threshold`` (strict).  The
    previous reading moves on every reading, checked or not; a key's first
    reading compares with ``initial``, one after a null reading with nothing.
    Output ``(id, ts, temperature,
    temp_diff)`` (+ seq).
    """
    th = thresholds.select(F.col(key), F.col(ts), F.col(seq),
                           F.col(threshold).alias("_thr"))
    u = _tagged_union(readings, th, {"_thr": "double"})
    u = u.withColumn("_rv", F.when(F.col("_src") == _READING, F.struct(F.col(value).alias("v"))))
    s = prefix_scan(u, [key], [ts, "_src", seq],
                    [Agg("_cur_thr", "last", "_thr"),
                     Agg("_prev", "last", "_rv", inclusive=False)])
    s = (s.filter((F.col("_src") == _READING) & F.col("_cur_thr").isNotNull()
                  & (F.col("_cur_thr") != 0.0))
          .withColumn("temp_diff",
                      abs_diff(value, F.when(F.col("_prev").isNull(), F.lit(initial))
                                     .otherwise(F.col("_prev.v")))))
    return (s.filter(F.col("temp_diff") > F.col("_cur_thr"))
             .select(key, ts, seq, value, "temp_diff"))


def threshold_table(thresholds: DataFrame, *, key: str = "id", ts: str = "ts",
                    seq: str = "seq", threshold: str = "threshold") -> DataFrame:
    """J3 state after all updates: the last update per key, without removed
    keys.  ``max_by`` is a plain aggregation (partial before the exchange)."""
    last = thresholds.groupBy(key).agg(
        F.max_by(F.col(threshold), F.struct(ts, seq)).alias(threshold))
    return last.filter(F.col(threshold) != 0.0)
