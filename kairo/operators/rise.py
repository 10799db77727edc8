"""Monotone-rise alert, batch form.

Per key, in ``(ts, seq)`` order, with ``prev`` the key's previous value
(unset reads 0.0):

* a row whose time reaches a pending deadline first fires it (alert at the
  deadline) — a deadline at T acts before a row at ``ts >= T``;
* ``prev == 0.0`` or ``value < prev``  (a *fall*)  cancels the timer;
* ``value > prev`` with no timer       (a *rise*)  arms ``ts + hold``;
* ``value == prev``                               leaves the timer alone.

Timers pending at the end of the input fire if their deadline is not after
the input's final watermark (its largest event time); later ones stay
pending and are not reported.

This is a fold, but its dependencies are short: every fall leaves the key
idle, so rows split into *segments* (a fall and the rises/equals after it).
Inside a segment, the first rise arms; an arm at ``t`` is followed by the
first rise at or after ``t + hold`` (the timer fired before it).  All arms
but the last of a segment fire; the last one fires unless the next fall
comes before its deadline.  The chain of arms is a linked list over rise
rows; it is marked with pointer doubling — each round follows the pointers
of the nodes reached so far and squares the pointer table — so the rounds
grow with ``log2`` of the longest chain, and no key or segment is ever
gathered into one task.  Each round cuts lineage by writing its tables into
the session's checkpoint folder; doubling stops once no pointer is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairo.functions.scalar import message
from kairo.plans.scan import (
    Agg, Chunks, default_chunk_rows, order_number, prefix_scan, with_chunks)
from kairo.session import materialize, release

MESSAGE = "Temperature of sensor '%s' monotonically increased %s."


def rise_alert(df: DataFrame, key: str = "id", order: Sequence[str] = ("ts", "seq"),
               value: str = "temperature", hold: str = "1 second"
               ) -> DataFrame:
    """Output ``(id, ts, armed_seq, message)``: one row per fired timer, at
    its deadline, with the arrival id of the row that armed it.  ``order`` is
    a total order inside a key; ``seq`` may repeat across keys."""
    ts, seq = list(order)
    hold_iv = F.expr(f"INTERVAL {hold}")

    # 1. previous value → row class; 2. segment number = falls so far.
    #    Both scans share one chunking; the result is written once.
    cut = with_chunks(df.select(key, ts, seq, value), [key], [ts, seq], default_chunk_rows(df))
    s = prefix_scan(cut.rows, [key], [ts, seq], [Agg("_p", "last", value, inclusive=False)],
                    chunks=cut)
    p, v = F.col("_p"), F.col(value)
    s = s.withColumn("_cls", F.when(p.isNull() | (p == 0.0) | (v < p), F.lit("F"))
                              .when(v > p, F.lit("R")).otherwise(F.lit("E")))
    s = prefix_scan(s, [key], [ts, seq],
                    [Agg("_seg", "count", F.when(F.col("_cls") == "F", 1))],
                    chunks=Chunks(s, cut.slices))
    s, _ = materialize(s.drop("_chunk", "_hot", "_p"), "rise-rows")

    # 3. one reverse scan over rows and deadline probes: next fall after each
    #    row, and the first rise at or after each rise's deadline
    rows = s.select(key, ts, seq, "_cls", "_seg", F.lit(0).alias("_kind"),
                    F.col(ts).alias("_t"), F.lit(None).cast("long").alias("_probe_of"))
    probes = s.filter(F.col("_cls") == "R").select(
        key, ts, seq, "_cls", "_seg", F.lit(1).alias("_kind"),
        (F.col(ts) + hold_iv).alias("_t"), F.col(seq).alias("_probe_of"))
    u = rows.unionByName(probes)
    u = u.withColumn("_rt", -order_number(u, "_t")).withColumn("_rs", -F.col(seq))
    is_rise = (F.col("_kind") == 0) & (F.col("_cls") == "R")
    is_fall = (F.col("_kind") == 0) & (F.col("_cls") == "F")
    u = prefix_scan(u, [key], ["_rt", "_kind", "_rs"], [
        Agg("_nr", "last", F.when(is_rise, F.col(seq))),
        Agg("_nr_seg", "last", F.when(is_rise, F.col("_seg"))),
        Agg("_next_f", "last", F.when(is_fall, F.col(ts)), inclusive=False)])

    # a node is a rise row; its name holds the key, since seq may repeat across keys
    def name(c: str) -> Column:
        return F.struct(F.col(key).alias("k"), F.col(c).alias("n"))

    nxt = (u.filter(F.col("_kind") == 1)
            .select(name("_probe_of").alias("node"),
                    F.when(F.col("_nr_seg") == F.col("_seg"), name("_nr")).alias("to")))
    nodes = (u.filter(is_rise)
              .select(name(seq).alias("node"), key, ts, F.col(seq).alias("_armed"), "_seg", "_next_f")
              .join(nxt, "node"))
    nodes, _ = materialize(nodes, "rise-nodes")
    release(s)

    # 4. the chains: start at the first rise of every segment, then double;
    #    nodes without a successor leave the pointer table, so it empties
    #    after log2 of the longest chain
    reached, _ = materialize(
        nodes.groupBy(key, "_seg").agg(F.min_by("node", F.struct(ts, "_armed")).alias("node"))
             .select("node"), "rise-reached")
    jump, n_jump = materialize(
        nodes.filter(F.col("to").isNotNull()).select("node", "to"), "rise-jump")
    while n_jump:
        step = reached.join(jump, "node").select(F.col("to").alias("node"))
        further, _ = materialize(reached.unionByName(step).distinct(), "rise-reached")
        a, b = jump.alias("a"), jump.alias("b")
        squared, n_jump = materialize(
            a.join(b, F.col("a.to") == F.col("b.node"))
             .select(F.col("a.node").alias("node"), F.col("b.to").alias("to")), "rise-jump")
        release(reached, jump)
        reached, jump = further, squared

    # 5. which arms fire
    end_wm = df.agg(F.max(ts)).scalar()          # scalar subquery, one value
    arms = nodes.join(reached, "node").withColumn("_end_wm", end_wm)
    deadline = F.col(ts) + hold_iv
    fired = (F.col("to").isNotNull()
             | (F.col("_next_f").isNotNull() & (F.col("_next_f") >= deadline))
             | (F.col("_next_f").isNull() & (deadline <= F.col("_end_wm"))))
    return (arms.filter(fired)
                .select(F.col(key), deadline.alias("ts"), F.col("_armed").alias("armed_seq"),
                        message(MESSAGE, key, F.lit(hold)).alias("message")))
