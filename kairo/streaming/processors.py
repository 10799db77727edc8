"""``StatefulProcessor`` classes: the stateful operators as streams.

All of them are the pandas form (``transformWithStateInPandas``): a key's rows come
as Arrow batches, and state is folded over numpy columns, not row by row, where the
rule allows.

``Ordered`` processors do not depend on arrival order.  A key's rows wait in map
state, in time buckets, until the watermark passes them; an event-time timer at the
oldest bucket then reads each released bucket once, folds its rows in ``(time,
source, seq)`` order and deletes it.  Buckets that are not due are not touched, so a
key's buffer costs its rows once, not once per timer.  Deadlines (gate end, state
expiry, rise timer) are settled in the same step, after the rows before them, so a
stream folds exactly what the batch form folds.

Window processors (``LateWindow``, ``LateUpdates``, ``EarlyFire``) keep a window's
state themselves, beyond the watermark where their rule says so, and see late rows,
which Spark would drop (``streaming.time.never_late``).

Times are LONG epoch microseconds (``t``, made by Catalyst from the event time), so
the worker's time zone plays no part; timers are in milliseconds.  A null in a
``double`` column is told apart from NaN by a boolean column of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor

#: Columns that ``Ordered`` reads from every row, before the payload.
ORDER = (("t", "long"), ("src", "int"), ("seq", "long"))
_DTYPES = {"long": np.int64, "int": np.int32, "double": np.float64, "boolean": bool}


def _ms_ceil(us: int) -> int:
    return -((-us) // 1000)


def _column(values, kind: str) -> np.ndarray:
    if kind in _DTYPES:
        return np.asarray(values, _DTYPES[kind])
    out = np.empty(len(values), object)
    out[:] = [None if v is None or v is pd.NaT or v != v else v for v in values]
    return out


def _id(key: tuple):
    """The output's key: the first of the grouping columns, null by the last one's
    word (``forms._state_rows``)."""
    return None if key[-1] else key[0]


def _frame(key, **columns) -> pd.DataFrame:
    n = max((len(c) for c in columns.values() if not np.isscalar(c)), default=0)
    return pd.DataFrame({"id": pd.Series([key] * n, dtype=object), **columns})


def _above(diff: np.ndarray, limit) -> np.ndarray:
    """``diff > limit`` as in Spark, where NaN is above every number."""
    return (diff > limit) | np.isnan(diff)


def _before(values: np.ndarray, first) -> np.ndarray:
    """The values shifted by one row, with ``first`` in front."""
    return np.concatenate([np.array([first], values.dtype), values[:-1]])


class Ordered(StatefulProcessor):
    """Buffers rows until the watermark passes them.

    Subclasses set ``payload`` (columns beside ``ORDER``), open their state in
    ``open``, and define ``fold(key, r)``, a generator of frames over sorted columns
    ``r``.  ``settle(key, now)`` handles deadlines up to ``now`` once all earlier
    rows are folded; ``deadline()`` names the next one.  ``expire`` (microseconds)
    forgets a key's state (``forget``) that long after its last row, by event time
    and exactly, whether or not the key returns.  With ``processing_time`` rows are
    folded as they arrive, at the wall-clock time of their micro-batch.
    """

    payload: tuple[tuple[str, str], ...] = ()
    processing_time = False
    expire: int | None = None
    bucket = 60_000_000

    def init(self, handle):
        self.handle = handle
        self.columns = (*ORDER, *self.payload)
        self.buffer = handle.getMapState(
            "buffer", "bucket long, chunk int",
            ", ".join(f"{n} array<{t}>" for n, t in self.columns))
        self.index = handle.getValueState(
            "index", "bucket array<long>, chunks array<int>, due long, last long")
        self.open(handle)

    def open(self, handle):
        pass

    def fold(self, key, r) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def settle(self, key, now) -> Iterator[pd.DataFrame]:
        return iter(())

    def deadline(self):
        return None

    def forget(self):
        pass

    def _load(self):
        got = self.index.get() if self.index.exists() else None
        self.held = dict(zip(got[0], got[1])) if got else {}
        self.due, self.last = (got[2], got[3]) if got else (None, None)

    def _store(self):
        """One timer: at the oldest bucket or the next deadline."""
        times = [t for t in (min(self.held, default=None), self.deadline()) if t is not None]
        if self.expire and self.last is not None:
            times.append(self.last + self.expire)
        new = _ms_ceil(min(times)) if times else None
        if self.due != new:
            if self.due is not None:
                self.handle.deleteTimer(self.due)
            if new is not None:
                self.handle.registerTimer(new)
            self.due = new
        if new is None and self.last is None:
            self.index.clear()
        else:
            self.index.update((list(self.held), list(self.held.values()), new, self.last))

    def _put(self, bucket: int, r: dict) -> None:
        chunk = self.held.get(bucket, 0)
        self.buffer.updateValue((bucket, chunk), tuple(r[n].tolist() for n, _ in self.columns))
        self.held[bucket] = chunk + 1

    def _take(self, bucket: int) -> dict:
        parts = []
        for chunk in range(self.held.pop(bucket)):
            parts.append(self.buffer.getValue((bucket, chunk)))
            self.buffer.removeKey((bucket, chunk))
        return {n: _column([x for p in parts for x in p[i]], t)
                for i, (n, t) in enumerate(self.columns)}

    def _arrays(self, df: pd.DataFrame) -> dict:
        return {n: _column(df[n].tolist() if t not in _DTYPES else df[n], t)
                for n, t in self.columns}

    def _ordered(self, key, r: dict) -> Iterator[pd.DataFrame]:
        """Fold rows in order; a gap of ``expire`` makes the state start anew."""
        order = np.lexsort((r["seq"], r["src"], r["t"]))
        r = {n: c[order] for n, c in r.items()}
        t = r["t"]
        if not self.expire:
            yield from self.fold(key, r)
            return
        new = np.flatnonzero(t - _before(t, t[0] if self.last is None else self.last)
                             >= self.expire)
        edges = [0, *[i for i in new.tolist() if i], len(t)]
        for a, b in zip(edges, edges[1:]):
            if a in new:
                yield from self.settle(key, int(t[a]))
                self.forget()
            yield from self.fold(key, {n: c[a:b] for n, c in r.items()})
        self.last = int(t[-1])

    def handleInputRows(self, key, rows, timerValues):
        self._load()
        for df in rows:
            r = self._arrays(df)
            if self.processing_time:
                now = timerValues.getCurrentProcessingTimeInMs() * 1000
                yield from self.settle(_id(key), now)
                order = np.lexsort((r["seq"], r["src"], r["t"]))
                r = {n: c[order] for n, c in r.items()}
                r["t"] = np.full(len(order), now)
                yield from self.fold(_id(key), r)
                continue
            bucket = r["t"] // self.bucket * self.bucket
            for b in np.unique(bucket).tolist():
                at = bucket == b
                self._put(b, {n: c[at] for n, c in r.items()})
        self._store()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._load()
        self.due = None
        if self.processing_time:
            now = timerValues.getCurrentProcessingTimeInMs() * 1000
        else:
            now = timerValues.getCurrentWatermarkInMs() * 1000
            for bucket in sorted(b for b in self.held if b <= now):
                r = self._take(bucket)
                later = r["t"] > now
                if later.any():
                    self._put(bucket, {n: c[later] for n, c in r.items()})
                if not later.all():
                    yield from self._ordered(_id(key), {n: c[~later] for n, c in r.items()})
        yield from self.settle(_id(key), now)
        if self.expire and self.last is not None and not self.held \
                and self.last + self.expire <= now:
            self.forget()
            self.last = None
        # a bucket that is due in part is looked at again once the watermark moves on
        self._store()

    def close(self):
        pass


READING = (("temperature", "double"), ("some", "boolean"))


class JumpAlert(Ordered):
    """``|value - last| > threshold``; unset last reads ``initial``.  A null
    reading is kept as the last one, with which nothing compares.  With ``expire``
    it is X2: the state is cleared that long after the key's last row."""

    payload = READING

    def __init__(self, threshold: float, initial: float | None = 0.0):
        self.threshold, self.initial = threshold, initial

    def open(self, handle):
        self.state = handle.getValueState("last", "v double")

    def forget(self):
        self.state.clear()

    def fold(self, key, r):
        prev = self.state.get()[0] if self.state.exists() else self.initial
        v, some = r["temperature"], r["some"]
        had = _before(some, prev is not None)
        diff = np.abs(v - _before(v, 0.0 if prev is None else prev))
        hit = some & had & _above(diff, self.threshold)
        if hit.any():
            yield _frame(key, t=r["t"][hit], seq=r["seq"][hit], temperature=v[hit],
                         temp_diff=diff[hit])
        self.state.update((float(v[-1]) if some[-1] else None,))


class RunningCount(Ordered):
    """One output row per (already filtered) input with the key's running
    count; ``bucket`` is handed on for A10."""

    payload = (("bucket", "int"),)

    def open(self, handle):
        self.count = handle.getValueState("count", "n long")

    def forget(self):
        self.count.clear()

    def fold(self, key, r):
        n = self.count.get()[0] if self.count.exists() else 0
        m = len(r["t"])
        self.count.update((n + m,))
        yield _frame(key, ts=pd.to_datetime(r["t"], unit="us", utc=True), seq=r["seq"],
                     bucket=r["bucket"], keyed_count=np.arange(n + 1, n + m + 1))


class BucketCount(Ordered):
    """A bucket's running count, over the rows that the operator before
    it in the same query has counted per key."""

    payload = (("id", "string"), ("keyed_count", "long"))

    def open(self, handle):
        self.count = handle.getValueState("count", "n long")

    def fold(self, key, r):
        n = self.count.get()[0] if self.count.exists() else 0
        m = len(r["t"])
        self.count.update((n + m,))
        yield pd.DataFrame({
            "id": pd.Series(r["id"].tolist(), dtype=object), "t": r["t"], "seq": r["seq"],
            "bucket": np.full(m, key, np.int32), "keyed_count": r["keyed_count"],
            "bucket_count": np.arange(n + 1, n + m + 1)})


class RollingSum(Ordered):
    """A1: every row with the running sum of the key's readings (null until one is
    not null)."""

    payload = READING

    def open(self, handle):
        self.sum = handle.getValueState("sum", "s double")

    def forget(self):
        self.sum.clear()

    def fold(self, key, r):
        before = self.sum.get()[0] if self.sum.exists() else None
        some = r["some"]
        v = np.where(some, r["temperature"], 0.0)
        total = np.cumsum(np.append(0.0 if before is None else before, v))[1:]
        known = np.logical_or.accumulate(some) | (before is not None)
        if known[-1]:
            self.sum.update((float(total[-1]),))
        yield _frame(key, t=r["t"], seq=r["seq"],
                     temperature=pd.Series(total, dtype=object).where(known, None))


class RollingArgMax(Ordered):
    """A2: every row with the key's record of the highest reading so far, the newer
    one on a tie (nulls lowest, NaN highest)."""

    payload = READING

    def open(self, handle):
        self.best = handle.getValueState("best", "v double, some boolean, t long, seq long")

    def forget(self):
        self.best.clear()

    def fold(self, key, r):
        best = tuple(self.best.get()) if self.best.exists() else None
        out, rank = [], None if best is None else self._rank(best[0], best[1])
        for v, some, t, seq in zip(r["temperature"].tolist(), r["some"].tolist(),
                                   r["t"].tolist(), r["seq"].tolist()):
            new = self._rank(v, some)
            if rank is None or new >= rank:
                best, rank = (v if some else None, some, t, seq), new
            out.append(best)
        self.best.update(best)
        v, _, t, seq = zip(*out)
        yield _frame(key, t=r["t"], seq=r["seq"], max_temperature=pd.Series(v, dtype=object),
                     max_t=np.array(t), max_seq=np.array(seq))

    @staticmethod
    def _rank(v, some):
        return (0, 0.0) if not some else (2, 0.0) if v != v else (1, v)


class Gate(Ordered):
    """Switches (``src == 0``) open the key's gate for their duration;
    readings (``src == 1``) pass while ``t < open_until``; a switch without a
    duration changes nothing.  The state is cleared at the gate's end.
    ``processing_time=True`` opens the gate for wall-clock time from the
    micro-batch that receives the switch (T6)."""

    payload = (("ts_us", "long"), *READING, ("duration_us", "long"))

    def __init__(self, processing_time: bool = False):
        self.processing_time = processing_time

    def open(self, handle):
        self.until = handle.getValueState("open_until", "u long")

    def fold(self, key, r):
        closed = np.iinfo(np.int64).min
        until = self.until.get()[0] if self.until.exists() else closed
        switch = (r["src"] == 0) & (r["duration_us"] >= 0)
        ends = np.maximum.accumulate(
            np.append(until, np.where(switch, r["t"] + r["duration_us"], closed)))[1:]
        hit = (r["src"] == 1) & (r["t"] < ends)
        if hit.any():
            yield _frame(key, t=r["ts_us"][hit], seq=r["seq"][hit],
                         temperature=pd.Series(r["temperature"][hit], dtype=object)
                         .where(r["some"][hit], None))
        if ends[-1] > closed:
            self.until.update((int(ends[-1]),))

    def deadline(self):
        return self.until.get()[0] if self.until.exists() else None

    def settle(self, key, now):
        if self.until.exists() and self.until.get()[0] <= now:
            self.until.clear()
        return iter(())


def _latest(place: np.ndarray) -> np.ndarray:
    """For every row the last row at or before it where ``place`` holds, or -1."""
    return np.maximum.accumulate(np.where(place, np.arange(len(place)), -1))


class ThresholdAlert(Ordered):
    """J3 + X4: control rows (``src == 0``) set or (0.0) remove the key's
    threshold, null ones change nothing; readings are checked against it and always
    move ``last``."""

    payload = (*READING, ("threshold", "double"), ("set", "boolean"))

    def __init__(self, initial: float = 0.0):
        self.initial = initial

    def open(self, handle):
        self.thr = handle.getValueState("threshold", "t double")
        self.last_value = handle.getValueState("last", "v double")

    def forget(self):
        self.thr.clear()
        self.last_value.clear()

    def state_of(self, key):
        """``(threshold or None, a reading was seen, last reading or None)``"""
        seen = self.last_value.exists()
        return (self.thr.get()[0] if self.thr.exists() else None, seen,
                self.last_value.get()[0] if seen else None)

    def keep(self, key, thr, seen, last):
        if thr is None:
            self.thr.clear()
        else:
            self.thr.update((thr,))
        if seen:
            self.last_value.update((last,))

    def fold(self, key, r):
        yield from self.fold_id(key, key, r)

    def fold_id(self, state_key, out_key, r):
        thr, seen, last = self.state_of(state_key)
        at = _latest((r["src"] == 0) & r["set"])
        limit = np.where(at >= 0, r["threshold"][at], 0.0 if thr is None else thr)
        reading = r["src"] == 1
        v, some = r["temperature"][reading], r["some"][reading]
        if len(v):
            first = last if seen else self.initial
            diff = np.abs(v - _before(v, 0.0 if first is None else first))
            lim = limit[reading]
            hit = some & _before(some, first is not None) & (lim != 0.0) & _above(diff, lim)
            hit &= ~np.isnan(lim)
            if hit.any():
                yield _frame(out_key, t=r["t"][reading][hit], seq=r["seq"][reading][hit],
                             temperature=v[hit], temp_diff=diff[hit])
            seen, last = True, float(v[-1]) if some[-1] else None
        self.keep(state_key, float(limit[-1]) if limit[-1] != 0.0 else None, seen, last)


class ThresholdTable(ThresholdAlert):
    """J3 + X4 with the thresholds as map state (K5): control rows are replicated
    to every bucket of readings, put or remove their id's entry, and readings look
    theirs up, whatever the stream is keyed by."""

    payload = (*ThresholdAlert.payload, ("id", "string"))

    def open(self, handle):
        self.table = handle.getMapState("thresholds", "id string", "t double")
        self.lasts = handle.getMapState("lasts", "id string", "v double")

    def forget(self):
        self.table.clear()
        self.lasts.clear()

    def state_of(self, key):
        thr = self.table.getValue((key,))[0] if self.table.containsKey((key,)) else None
        seen = self.lasts.containsKey((key,))
        return thr, seen, self.lasts.getValue((key,))[0] if seen else None

    def keep(self, key, thr, seen, last):
        if thr is not None:
            self.table.updateValue((key,), (thr,))
        elif self.table.containsKey((key,)):
            self.table.removeKey((key,))
        if seen:
            self.lasts.updateValue((key,), (last,))

    def fold(self, key, r):
        ids = pd.Series(r["id"], dtype=object)
        for id, at in ids.groupby(ids, sort=False).indices.items():
            at = np.sort(at)
            yield from self.fold_id(id, id, {n: c[at] for n, c in r.items()})


class LatestLevel(Ordered):
    """J2 + X5 per bucket: control rows (``src == 0``, replicated to every
    bucket) set the level, null ones change nothing; readings above ``above`` while
    HIGH alert."""

    payload = (*READING, ("id", "string"), ("level", "string"))

    def __init__(self, above: float, initial: str = "LOW"):
        self.above, self.initial = above, initial

    def open(self, handle):
        self.level = handle.getValueState("level", "l string")

    def fold(self, key, r):
        level = self.level.get()[0] if self.level.exists() else self.initial
        given = (r["src"] == 0) & np.array([x is not None for x in r["level"]], bool)
        at = _latest(given)
        now = np.where(at >= 0, r["level"][at], level)
        v = r["temperature"]
        hit = (r["src"] == 1) & (now == "HIGH") & r["some"] & _above(v, self.above)
        if hit.any():
            yield pd.DataFrame({"id": pd.Series(r["id"][hit].tolist(), dtype=object),
                                "t": r["t"][hit], "message": "Risk of fire!"})
        self.level.update((str(now[-1]),))


class RiseAlert(Ordered):
    """A rise arms a timer ``hold`` later, a fall (or a previous value of
    0.0) cancels it, an equal value leaves it; the timer emits the message.  A null
    reading compares with nothing and leaves the previous value as it is."""

    payload = READING

    def __init__(self, hold_us: int, message: str, processing_time: bool = False):
        self.hold, self.message, self.processing_time = hold_us, message, processing_time

    def open(self, handle):
        self.prev = handle.getValueState("prev", "v double")
        self.timer = handle.getValueState("deadline", "d long")

    def forget(self):
        self.prev.clear()
        self.timer.clear()

    def _alerts(self, key, deadlines):
        return _frame(key, t=np.array(deadlines, np.int64), message=[self.message % key] * len(deadlines))

    def fold(self, key, r):
        prev = self.prev.get()[0] if self.prev.exists() else 0.0
        timer = self.timer.get()[0] if self.timer.exists() else None
        fired = []
        for t, v, some in zip(r["t"].tolist(), r["temperature"].tolist(), r["some"].tolist()):
            if timer is not None and timer <= t:
                fired.append(timer)
                timer = None
            p = prev
            if some:
                prev = v
            if p == 0.0 or some and (v < p or p != p and v == v):
                timer = None
            elif some and timer is None and (v > p or v != v and p == p):
                timer = t + self.hold
        if fired:
            yield self._alerts(key, fired)
        self.prev.update((prev,))
        if timer is None:
            self.timer.clear()
        else:
            self.timer.update((timer,))

    def deadline(self):
        return self.timer.get()[0] if self.timer.exists() else None

    def settle(self, key, now):
        if self.timer.exists() and self.timer.get()[0] <= now:
            deadline = self.timer.get()[0]
            self.timer.clear()
            yield self._alerts(key, [deadline])


def _watermark(timerValues) -> int | None:
    """The micro-batch's watermark in microseconds, None before there is one."""
    ms = timerValues.getCurrentWatermarkInMs()
    return ms * 1000 if ms > 0 else None


def _sorted(rows, *by: str) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(list(by), kind="stable")


class LateDetector(StatefulProcessor):
    """L2 (+ L4): every row with its ``late`` flag and the key's running late
    count.  A row is late when its event time is below the watermark of its
    micro-batch, which knows the rows of earlier micro-batches only."""

    def init(self, handle):
        self.count = handle.getValueState("late_count", "n long")

    def handleInputRows(self, key, rows, timerValues):
        wm = _watermark(timerValues)
        df = _sorted(rows, "seq")
        n = self.count.get()[0] if self.count.exists() else 0
        t = df["t"].to_numpy()
        late = np.zeros(len(t), bool) if wm is None else t < wm
        count = n + np.cumsum(late)
        if late.any():
            self.count.update((int(count[-1]),))
        yield _frame(_id(key), ts=pd.to_datetime(t, unit="us", utc=True), seq=df["seq"].to_numpy(),
                     late=late, late_count=count)

    def close(self):
        pass


class LateReport(StatefulProcessor):
    """L4: a key's late rows are counted, and one processing-time timer per key,
    which renews itself, reports the count so far at every tick.  The counter is
    never reset."""

    def __init__(self, every_ms: int):
        self.every = every_ms

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("report", "n long, tick long")

    def handleInputRows(self, key, rows, timerValues):
        new = sum(len(df) for df in rows)
        if self.state.exists():
            n, tick = self.state.get()
        else:
            n, tick = 0, timerValues.getCurrentProcessingTimeInMs() + self.every
            self.handle.registerTimer(tick)
        self.state.update((n + new, tick))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        n, tick = self.state.get()
        now = timerValues.getCurrentProcessingTimeInMs()
        due = tick + (now - tick) // self.every * self.every     # the last tick that has passed
        self.handle.registerTimer(due + self.every)
        self.state.update((n, due + self.every))
        yield _frame(_id(key), tick=np.array([due * 1000]), late_count=np.array([n]))

    def close(self):
        pass


class LateWindow(StatefulProcessor):
    """L1, keyed by (key, window): ``main`` counts a window's rows until the
    watermark passes its end; rows that come later go to ``late``, one by one."""

    def init(self, handle):
        self.handle = handle
        self.count = handle.getValueState("count", "n long, end long")

    def _out(self, key, kind, end, cnt, t, seq):
        n = len(t)
        return _frame(_id(key), kind=[kind] * n, end=np.full(n, end),
                      cnt=pd.Series(cnt, dtype=object), et=pd.Series(t, dtype=object),
                      seq=pd.Series(seq, dtype=object))

    def handleInputRows(self, key, rows, timerValues):
        wm = _watermark(timerValues)
        df = _sorted(rows, "seq")
        end = int(df["end"].iloc[0])
        if wm is not None and end <= wm:
            yield self._out(key, "late", end, [None] * len(df), df["t"].tolist(),
                            df["seq"].tolist())
            return
        n = self.count.get()[0] if self.count.exists() else 0
        if not n:
            self.handle.registerTimer(_ms_ceil(end))
        self.count.update((n + len(df), end))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        n, end = self.count.get()
        self.count.clear()
        yield self._out(key, "main", end, [n], [None], [None])

    def close(self):
        pass


class LateUpdates(StatefulProcessor):
    """L3: window counts with allowed lateness.  The state outlives the watermark
    by the allowance: a window emits its count as ``first`` when the watermark passes
    its end, and again as ``update`` with every row that comes until the allowance
    is over; rows after that are dropped.

    Map state holds the open windows of one group.  Grouped by (key, window), the
    tag is the window's; grouped by key alone (``by_key``), the tag is the key's,
    so all emissions after its very first say ``update``."""

    def __init__(self, allowance_us: int, by_key: bool):
        self.allowance, self.by_key = allowance_us, by_key

    def init(self, handle):
        self.handle = handle
        self.windows = handle.getMapState("windows", "end long", "n long, emitted boolean")
        self.flag = handle.getValueState("emitted", "done boolean")

    def _emit(self, end: int, n: int, first: bool) -> tuple:
        if self.by_key:
            first = not self.flag.exists()
            if first:
                self.flag.update((True,))
        return end, n, "first" if first else "update"

    def _fire(self, wm: int) -> list[tuple]:
        """Close windows whose end has passed, oldest first; let go of those whose
        allowance is over."""
        out = []
        for (end,), (n, emitted) in sorted(
                (tuple(k), tuple(v)) for k, v in self.windows.iterator()):
            if end > wm:
                continue
            if not emitted:
                out.append(self._emit(end, n, True))
            if end + self.allowance <= wm:
                self.windows.removeKey((end,))
            elif not emitted:
                self.windows.updateValue((end,), (n, True))
                self.handle.registerTimer(_ms_ceil(end + self.allowance))
        return out

    def _frame(self, key, out: list[tuple]) -> pd.DataFrame:
        end, cnt, tag = zip(*out)
        return _frame(_id(key), end=np.array(end), cnt=np.array(cnt), tag=list(tag))

    def handleInputRows(self, key, rows, timerValues):
        wm = _watermark(timerValues)
        out = self._fire(wm) if wm is not None else []
        df = _sorted(rows, "seq")
        ends = df["end"].to_numpy()
        if wm is not None:
            ends = ends[ends + self.allowance > wm]
        count: dict[int, list] = {}
        for end in ends.tolist():
            if end not in count:
                new = not self.windows.containsKey((end,))
                count[end] = [0, False, new] if new else [*self.windows.getValue((end,)), False]
            state = count[end]
            state[0] += 1
            if wm is not None and end <= wm:
                out.append(self._emit(end, state[0], not state[1]))
                state[1] = True
        for end, (n, emitted, new) in count.items():
            self.windows.updateValue((end,), (n, emitted))
            if new:
                self.handle.registerTimer(
                    _ms_ceil(end + self.allowance if emitted else end))
        if out:
            yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        out = self._fire(timerValues.getCurrentWatermarkInMs() * 1000)
        if out:
            yield self._frame(key, out)

    def close(self):
        pass


class EarlyFire(StatefulProcessor):
    """W3, keyed by (key, window): from the pane of the first row on, every pane
    end before the window's end emits the maxima so far; the window's end emits them
    once more and closes the window.  The timer renews itself from pane end to pane
    end; a watermark that passes several emits one row for each.  Rows are kept as
    maxima per pane until their pane's end has passed."""

    def __init__(self, pane_us: int):
        self.pane = pane_us

    def init(self, handle):
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane long", "t long, v double, some boolean")
        self.state = handle.getValueState(
            "fired", "next long, end long, t long, v double, some boolean")

    @staticmethod
    def _max(a, b):
        """Larger time; larger value, nulls lowest, NaN highest."""
        v = max((RollingArgMax._rank(x[1], x[2]), x[1], x[2]) for x in (a, b))
        return max(a[0], b[0]), v[1] if v[2] else None, v[2]

    def handleInputRows(self, key, rows, timerValues):
        first = None
        for df in rows:
            end = int(df["end"].iloc[0])
            pane = (df["t"] // self.pane + 1) * self.pane
            for p, part in df.groupby(pane, sort=False):
                v = part["temperature"][part["some"]].to_numpy()
                new = (int(part["t"].max()), float(np.max(v)) if len(v) else None, bool(len(v)))
                p = int(p)
                if self.panes.containsKey((p,)):
                    new = self._max(tuple(self.panes.getValue((p,))), new)
                self.panes.updateValue((p,), new)
                first = p if first is None else min(first, p)
        at = min(first, end)
        if self.state.exists():
            old = tuple(self.state.get())
            if old[0] <= at:
                return iter(())
            self.handle.deleteTimer(_ms_ceil(old[0]))
            self.state.update((at, *old[1:]))
        else:
            self.state.update((at, end, None, None, False))
        self.handle.registerTimer(_ms_ceil(at))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000
        at, end, *best = self.state.get()
        best = None if best[0] is None else tuple(best)
        waiting = sorted((int(k[0]), tuple(v)) for k, v in self.panes.iterator())
        out = []
        while at <= now and at <= end:
            while waiting and (waiting[0][0] <= at or at == end):
                pane, new = waiting.pop(0)
                self.panes.removeKey((pane,))
                best = new if best is None else self._max(best, new)
            out.append((at, *best, at == end))
            at = end + 1 if at == end else min(at + self.pane, end)
        if at > end:
            self.state.clear()
        else:
            self.state.update((at, end, *best))
            self.handle.registerTimer(_ms_ceil(at))
        if out:
            fire, t, v, _, final = zip(*out)
            yield _frame(_id(key), end=np.full(len(out), end), fire=np.array(fire), t=np.array(t),
                         temperature=pd.Series(v, dtype=object), final=np.array(final))

    def close(self):
        pass
