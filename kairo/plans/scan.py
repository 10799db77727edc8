"""Keyed prefix scans that stay balanced when one key holds much of the data.

Most operators of this library are *running* computations along a key's
event-time order: previous value (lag), running sum / count / max, the last
non-null control value seen so far (as-of lookups), the global running
maximum of event time (arrival watermark).  The direct form is a window
``partitionBy(key).orderBy(ts, seq)``, but a key holding a third of all rows
then lands in a single task.  ``prefix_scan`` cuts such keys into slices:

1. One aggregation counts rows per key (partial aggregation before the
   exchange).  Keys with more than ``chunk_rows`` rows are *hot*.  A scan
   without keys is one key that is always cut, into at least as many slices
   as there are shuffle partitions.
2. A hot key is cut into slices of equal numbers of rows, as many as its own
   count asks for (a power of two): their bounds are approximate quantiles
   of the key's first order column.  Rows that share a bound's value form a
   slice of their own, and where that value alone exceeds a slice (a burst) it
   is cut again at quantiles of the second order column.  The slice is a pure
   function of the row and the written bounds, so every branch of the plan and
   every task retry assigns the same one.
3. Rows are dealt once, by (key, slice).  A window over (key, slice) gives the
   running values inside the slice.
4. Hot keys only: one summary row per (key, slice), pre-aggregated, and a
   window over these few rows give the carry of all earlier slices.  It is
   joined back on (key, slice), by which the rows already lie, so only the
   carry moves.

The bounds are always broadcast, and their size has a bound that holds for any
input: slices have at least ``rows / TOTAL_SLICES`` rows, so there are at most
``TOTAL_SLICES`` hot keys and four times as many bounds, ``BOUND_BYTES`` a slice
in all.  No row is ever dealt by its key alone unless the key fits a slice.  The
carry is broadcast only within ``BROADCAST_BYTES``; beyond it the join takes the
partitioning that the rows have.  Doubles are added in the order of rows inside
a slice and of slices inside a key; everything else does not depend on the cut.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairo.session import materialize, release

_KINDS = ("sum", "count", "max", "min", "first", "last")

@dataclass(frozen=True)
class Agg:
    """One running value: ``kind`` of ``expr`` over the key's rows so far.

    ``inclusive=False`` excludes the current row (``lag``-like: the value
    *before* this row).  ``first``/``last`` skip nulls; ``count`` counts
    non-null values.
    """

    name: str
    kind: str
    expr: Column | str
    inclusive: bool = True

    def __post_init__(self):
        if self.kind not in _KINDS:
            raise ValueError(f"unknown scan kind {self.kind!r}")


def _col(e: Column | str) -> Column:
    return F.col(e) if isinstance(e, str) else e


def _window_fn(kind: str, c: Column) -> Column:
    if kind == "sum":
        return F.sum(c)
    if kind == "count":
        return F.count(c)
    if kind == "max":
        return F.max(c)
    if kind == "min":
        return F.min(c)
    if kind == "first":
        return F.first(c, ignorenulls=True)
    return F.last(c, ignorenulls=True)


def _chunk_total(kind: str, c: Column, order_struct: Column) -> Column:
    if kind == "sum":
        return F.sum(c)
    if kind == "count":
        return F.count(c)
    if kind == "max":
        return F.max(c)
    if kind == "min":
        return F.min(c)
    ordered = F.when(c.isNotNull(), order_struct)
    if kind == "first":
        return F.min_by(c, ordered)
    return F.max_by(c, ordered)


def _carry_fn(kind: str, c: Column) -> Column:
    if kind in ("sum", "count"):
        return F.sum(c)
    if kind == "max":
        return F.max(c)
    if kind == "min":
        return F.min(c)
    if kind == "first":
        return F.first(c, ignorenulls=True)
    return F.last(c, ignorenulls=True)


def _combine(kind: str, carry: Column, local: Column) -> Column:
    if kind in ("sum", "count"):
        return F.coalesce(carry + local, local, carry)
    if kind == "max":
        return F.greatest(carry, local)
    if kind == "min":
        return F.least(carry, local)
    if kind == "first":
        return F.coalesce(carry, local)
    return F.coalesce(local, carry)


# Session setting for the rows per chunk of a hot key.
CHUNK_ROWS_CONF = "kairo.scan.chunkRows"
DEFAULT_CHUNK_ROWS = 500_000
#: Slices of all hot keys together, about; on larger inputs slices have more rows.
TOTAL_SLICES = 1 << 17
#: Most slices of one key, as a power of two: what its quantiles' digest can hold.
MAX_LG = 15
#: Bytes of a hot key's name and bounds for each of its slices, at most.
BOUND_BYTES = 256
#: Largest carry that a scan broadcasts.
BROADCAST_BYTES = 8 << 20


def default_chunk_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(CHUNK_ROWS_CONF, str(DEFAULT_CHUNK_ROWS)))


def order_number(df: DataFrame, name: str) -> Column:
    """A numeric, order-preserving image of an order column."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, T.TimestampNTZType):
        # NTZ - NTZ is zone-free; timestampdiff would pass through the
        # session zone and break monotonicity at daylight-saving gaps.
        i = f"(`{name}` - TIMESTAMP_NTZ'1970-01-01 00:00:00')"
        return F.expr(
            f"cast(extract(DAY FROM {i}) as bigint) * 86400000000"
            f" + cast(extract(HOUR FROM {i}) as bigint) * 3600000000"
            f" + cast(extract(MINUTE FROM {i}) as bigint) * 60000000"
            f" + cast(extract(SECOND FROM {i}) * 1000000 as bigint)")
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dt, T.NumericType):
        return c
    raise TypeError(f"cannot chunk on column {name} of type {dt}")


def _key(keys: Sequence[str]) -> Column:
    """The key as one value that is never null, so that plain equality also
    matches null keys."""
    return F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))


def _maybe_broadcast(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def _quantiles(position: Column, slices: int) -> Column:
    steps = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    return F.percentile_approx(position, steps, max(10_000, 4 * slices))


def _lg(slices: Column) -> Column:
    """Number of slices, as the exponent of the next power of two."""
    return F.least(F.greatest(F.ceil(F.log2(slices)), F.lit(1)), F.lit(MAX_LG)).cast("int")


def _bounds(rows: DataFrame, by: Sequence[str], position: Column, classes: Sequence[int]
            ) -> DataFrame:
    """Quantiles ``_q`` of the position per group of ``by``, in ``2 ** _lg`` parts;
    ``classes``: the values of ``_lg`` that occur."""
    found = [_quantiles(F.when(F.col("_lg") == c, position), 1 << c).alias(f"_q{c}") for c in classes]
    return rows.groupBy(*by, "_lg").agg(*found).select(
        *by, "_lg", F.coalesce(*[F.col(f"_q{c}") for c in classes]).alias("_q"))


def _split_bounds(q: DataFrame) -> DataFrame:
    """Sorted quantiles ``_q`` as distinct bounds in groups of ``_step`` (for a
    two-level lookup), and the values that stand more than once (``_bursts``) with
    how often."""
    step = F.expr("cast(pow(2, _lg div 2) as int)")
    again = F.expr("""transform(
        array_distinct(transform(
            filter(transform(_q, (v, i) -> named_struct('v', v, 'i', i)),
                   p -> p.i > 0 AND get(_q, p.i - 1) = p.v), p -> p.v)),
        v -> named_struct('v', v, 'n', size(filter(_q, x -> x = v))))""")
    return (q.withColumns({"_step": step, "_bursts": again, "_b": F.array_distinct("_q")})
            .withColumn("_groups", F.expr(
                "transform(sequence(0, (size(_b) - 1) div _step), "
                "k -> slice(_b, cast(k * _step + 1 as int), _step))"))
            .withColumn("_tops", F.transform(F.expr("slice(_groups, 1, size(_groups) - 1)"),
                                             lambda g: F.element_at(g, -1)))
            .drop("_q", "_b"))


@dataclass(frozen=True)
class Chunks:
    """The cut of a frame: ``rows`` with ``_chunk`` and ``_hot``; ``slices``
    bounds the number of (key, slice) pairs of hot keys (0: none is hot)."""

    rows: DataFrame
    slices: int


def with_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                chunk_rows: int) -> Chunks:
    """Add ``_chunk``, the slice of each row along ``order`` inside its key
    (0 throughout for keys of at most ``chunk_rows`` rows), and ``_hot``."""
    keys, order = list(keys), list(order)
    spark = df.sparkSession
    first = df.withColumns({"_ck": _key(keys), "_pos": order_number(df, order[0])})
    if keys:
        counted = df.groupBy(*[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
        total, most = counted.agg(F.sum("_n"), F.max("_n")).first()
        least = max(chunk_rows, -(-(total or 0) // TOTAL_SLICES))
        if not total or most <= least:
            return Chunks(df.withColumns({"_chunk": F.lit(0).cast("long"), "_hot": F.lit(False)}), 0)
        hot, _ = materialize(counted.filter(F.col("_n") > least).select(
            _key(keys).alias("_hk"), _lg(F.col("_n") / least).alias("_lg")), "scan-hot")
        sizes = {r["_lg"]: r["n"] for r in hot.groupBy("_lg").agg(F.count(F.lit(1)).alias("n"))
                 .collect()}
        quantiles = _bounds(first.select("_ck", "_pos").join(
            F.broadcast(hot), F.col("_ck") == F.col("_hk")), ["_hk"], F.col("_pos"), list(sizes))
        bounds, _ = materialize(_split_bounds(quantiles), "scan-bounds")
        release(hot)
        burst = bounds.agg(F.max(F.expr("array_max(transform(_bursts, b -> b.n))"))).first()[0]
        total_slices = sum((1 << c) * n for c, n in sizes.items())
    else:
        # one key: its count and its quantiles in one job, the bounds by way of the driver
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        lg = min(MAX_LG, max(1, (parts - 1).bit_length()))
        total, q = first.agg(F.count(F.lit(1)), _quantiles(F.col("_pos"), 1 << lg)).first()
        if not total:
            return Chunks(df.withColumns({"_chunk": F.lit(0).cast("long"), "_hot": F.lit(False)}), 0)
        asked = min(MAX_LG, (-(-total // max(chunk_rows, -(-total // TOTAL_SLICES))) - 1).bit_length())
        if asked > lg:
            lg = asked
            q = first.agg(_quantiles(F.col("_pos"), 1 << lg)).first()[0]
        q = q or []
        kind = first.schema["_pos"].dataType
        local = spark.createDataFrame([(lg, q)], T.StructType([
            T.StructField("_lg", T.IntegerType()), T.StructField("_q", T.ArrayType(kind))]))
        bounds = _split_bounds(local).withColumn("_hk", _key([]))
        burst = max((q.count(v) for v, w in zip(q, q[1:]) if v == w), default=None)
        total_slices = 1 << lg
    placed = first.join(F.broadcast(bounds), F.col("_ck") == F.col("_hk"), "left")
    # two-level lookup: the group of bounds, then the place in it
    group = F.size(F.filter("_tops", lambda v: v < F.col("_pos")))
    inner = F.element_at("_groups", group + 1)
    below = group * F.col("_step") + F.size(F.filter(inner, lambda v: v < F.col("_pos")))
    slot = F.when(F.col("_hk").isNull() | F.col("_pos").isNull(), F.lit(0)).otherwise(F.coalesce(
        2 * below + F.array_contains(inner, F.col("_pos")).cast("int"), F.lit(0))).cast("long")
    part, slices = F.lit(0), 2 * total_slices
    if len(order) > 1 and burst:
        second = order_number(df, order[1])
        # a value that stands n times among the quantiles has about n slices of rows
        times = F.expr("get(filter(_bursts, b -> b.v = _pos), 0).n")
        rows = (placed.withColumns({"_pos2": second, "_lg": _lg(times + 1)})
                .filter(times.isNotNull())
                .select(F.col("_hk").alias("_bk"), F.col("_pos").alias("_bp"), "_pos2", "_lg"))
        inner, n_inner = materialize(
            _bounds(rows, ["_bk", "_bp"], F.col("_pos2"), range(1, min(MAX_LG, burst.bit_length()) + 1))
            .select("_bk", "_bp", F.array_distinct("_q").alias("_inner")), "scan-bursts")
        placed = placed.join(F.broadcast(inner),
                             (F.col("_ck") == F.col("_bk")) & (F.col("_pos") == F.col("_bp")), "left")
        part = F.coalesce(F.size(F.filter("_inner", lambda v: v < second)), F.lit(0))
        part = F.when(F.col("_inner").isNull(), F.lit(0)).otherwise(part)
        slices += 4 * total_slices + 2 * n_inner
    rows = placed.withColumns({"_chunk": F.shiftleft(slot, 20) + part,
                               "_hot": F.col("_hk").isNotNull()}).select(*df.columns, "_chunk", "_hot")
    return Chunks(rows, slices)


def prefix_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                aggs: Sequence[Agg], *, chunk_rows: int | None | str = "auto",
                chunks: Chunks | None = None) -> DataFrame:
    """Add one column per ``Agg``: its running value along ``order`` within
    each ``keys`` group (all rows when ``keys`` is empty).

    ``order`` must be a total order inside a key (e.g. ``ts, seq``).
    ``chunk_rows="auto"`` reads the session setting ``kairo.scan.chunkRows``;
    ``None`` disables slicing (direct window).  ``chunks`` reuses a cut of the
    same keys and order whose rows are ``df`` with ``_chunk`` and ``_hot``;
    both columns then stay in the output.
    """
    keys, order = list(keys), list(order)
    if chunk_rows == "auto":
        chunk_rows = default_chunk_rows(df)
    inputs = {f"_in{i}": _col(a.expr) for i, a in enumerate(aggs)}

    def frame(w, inclusive):
        return w.rowsBetween(Window.unboundedPreceding,
                             Window.currentRow if inclusive else -1)

    kept = chunks is not None
    if chunks is None and chunk_rows is not None:
        chunks = with_chunks(df, keys, order, int(chunk_rows))
        df = chunks.rows
    base = df.withColumns(inputs)
    if chunks is None or chunks.slices == 0:
        # every key fits one task: the slice would be the whole key
        w = Window.partitionBy(*keys).orderBy(*order)
        out = base.withColumns({
            a.name: _window_fn(a.kind, F.col(f"_in{i}")).over(frame(w, a.inclusive))
            for i, a in enumerate(aggs)}).drop(*inputs)
        return out if kept else out.drop("_chunk", "_hot")

    # rows are dealt once, for the window and the join; the summary is a partial
    # aggregation, of which only one row per task and slice moves
    named = base.withColumn("_ck", _key(keys))
    dealt = named.repartition("_ck", "_chunk")
    wl = Window.partitionBy("_ck", "_chunk").orderBy(*order)
    local = dealt.withColumns({
        f"_loc{i}": _window_fn(a.kind, F.col(f"_in{i}")).over(frame(wl, a.inclusive))
        for i, a in enumerate(aggs)})
    order_struct = F.struct(*[F.col(o) for o in order])
    summary = named.filter("_hot").groupBy("_ck", "_chunk").agg(*[
        _chunk_total(a.kind, F.col(f"_in{i}"), order_struct).alias(f"_tot{i}")
        for i, a in enumerate(aggs)])
    wc = Window.partitionBy("_ck").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        F.col("_ck").alias("_sk"), F.col("_chunk").alias("_sc"),
        *[_carry_fn(a.kind, F.col(f"_tot{i}")).over(wc).alias(f"_car{i}")
          for i, a in enumerate(aggs)])
    carry = _maybe_broadcast(carry, chunks.slices, 64 * (2 + len(aggs)))
    joined = local.join(carry, (F.col("_ck") == F.col("_sk")) & (F.col("_chunk") == F.col("_sc")),
                        "left")
    out = joined.withColumns({
        a.name: _combine(a.kind, F.col(f"_car{i}"), F.col(f"_loc{i}"))
        for i, a in enumerate(aggs)})
    drop = [*inputs, "_ck", "_sk", "_sc", *[f"_loc{i}" for i in range(len(aggs))],
            *[f"_car{i}" for i in range(len(aggs))]]
    if not kept:
        drop += ["_chunk", "_hot"]
    return out.drop(*drop)
