"""Rolling keyed aggregates: one output row per input row.

Each is a prefix scan along ``(ts, seq)`` inside the key (see
``kairo.plans.scan``), so a hot key is scanned in parallel chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairo.plans.scan import Agg, prefix_scan
from kairo.session import materialize


def rolling_sum(df: DataFrame, key: str, order: Sequence[str], field: str, *,
                carry: str = "first") -> DataFrame:
    """A1: running sum of ``field`` per key.

    As in a keyed ``sum(field)``, the other (non-key, non-order) fields are
    those of the key's *first* row, nulls included (``carry="first"``), or of the current row
    (``carry="current"``); the order columns always identify the current
    row.  ``field`` may be the key itself (the reference sums its key field).
    """
    order = list(order)
    others = [c for c in df.columns if c not in (key, field, *order)]
    aggs = [Agg("_sum", "sum", field)]
    if carry == "first":
        # wrapped, so that a null in the first row stays the first value
        aggs += [Agg(f"_first_{c}", "first", F.struct(F.col(c).alias("v"))) for c in others]
    out = prefix_scan(df, [key], order, aggs)
    if carry == "first":
        out = out.withColumns({c: F.col(f"_first_{c}.v") for c in others}).drop(
            *[f"_first_{c}" for c in others])
    if field == key:
        return out.select(*[F.col("_sum").alias(c) if c == field else F.col(c)
                            for c in df.columns])
    return out.withColumn(field, F.col("_sum")).drop("_sum").select(*df.columns)


def rolling_argmax(df: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """A2: running arg-max per key: the whole record with the highest
    ``value`` so far; on a tie the newer record wins.

    ``max(struct(value, order...))`` compares the value first and then the
    order, so the newer of two equal maxima is the larger struct.  Output:
    the current row's order columns plus the winning record's columns,
    prefixed ``max_``.
    """
    order = list(order)
    rec = [value] + order + [c for c in df.columns if c not in (key, value, *order)]
    out = prefix_scan(df, [key], order,
                      [Agg("_best", "max", F.struct(*[F.col(c) for c in rec]))])
    return out.select(F.col(key), *[F.col(o) for o in order],
                      *[F.col(f"_best.{c}").alias(f"max_{c}") for c in rec])


def running_count(df: DataFrame, key: str, order: Sequence[str], predicate: Column, *,
                  out: str = "keyed_count") -> DataFrame:
    """A9 (+P6): rows matching ``predicate`` (e.g. above a threshold), each
    with the key's running count of matches."""
    return prefix_scan(df.filter(predicate), [key], order, [Agg(out, "count", F.lit(1))])


def keyed_and_bucket_counts(df: DataFrame, key: str, order: Sequence[str],
                            predicate: Column, bucket: Column) -> DataFrame:
    """A10: each matching row with the key's running count and the running
    count of its bucket (bucket = group of keys, e.g. a hash of the key, which
    unlike a task index is stable across restarts), both along ``order``.

    Output ``(key, order..., bucket, keyed_count, bucket_count)``.
    """
    # written once: each scan reads its rows for statistics and for the result
    m, _ = materialize(df.filter(predicate).withColumn("bucket", bucket), "bucket-rows")
    m, _ = materialize(prefix_scan(m, [key], order, [Agg("keyed_count", "count", F.lit(1))]),
                       "bucket-keyed")
    return prefix_scan(m, ["bucket"], order, [Agg("bucket_count", "count", F.lit(1))])


def bucket_counts(df: DataFrame, order: Sequence[str], predicate: Column,
                  bucket: Column) -> DataFrame:
    """Matching rows with only their bucket's running count:
    ``(bucket, count)`` plus the order columns."""
    m = df.filter(predicate).withColumn("bucket", bucket)
    out = prefix_scan(m, ["bucket"], order, [Agg("count", "count", F.lit(1))])
    return out.select("bucket", *order, "count")
