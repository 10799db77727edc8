"""Scalar column helpers.  All are Catalyst expressions (codegen, no Python
in the data path)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fahrenheit_to_celsius(c: Column | str) -> Column:
    """``(t - 32) * (5.0 / 9.0)``."""
    return (_c(c) - F.lit(32)) * F.lit(5.0 / 9.0)


def split_explode(df: DataFrame, col: str, delimiter: str, *, out: str = "part",
                  pos: str | None = "pos") -> DataFrame:
    """P5: one row per part of ``col`` split on a literal delimiter.

    Empty parts (leading, trailing, doubled delimiters) are kept.  ``split``
    takes a regular expression, so the delimiter is quoted.
    """
    parts = F.split(_c(col), re.escape(delimiter), -1)
    if pos:
        return df.select("*", F.posexplode(parts).alias(pos, out))
    return df.select("*", F.explode(parts).alias(out))


def abs_diff(a: Column | str, b: Column | str) -> Column:
    """``|a - b|``."""
    return F.abs(_c(a) - _c(b))


def pair_max(a: Column | str, b: Column | str) -> Column:
    """Two-argument maximum.  Spark orders NaN above every number, so
    ``pair_max(NaN, 1) = NaN`` and ``pair_min(NaN, 1) = 1``."""
    return F.greatest(_c(a), _c(b))


def pair_min(a: Column | str, b: Column | str) -> Column:
    return F.least(_c(a), _c(b))


def tuple_of(*cols: Column | str, names: list[str] | None = None) -> Column:
    """A named struct in place of positional tuples (f0, f1, ...)."""
    names = names or [f"f{i}" for i in range(len(cols))]
    return F.struct(*[_c(c).alias(n) for c, n in zip(cols, names)])


def message(fmt: str, *cols: Column | str) -> Column:
    """P10: string interpolation with ``%s`` placeholders."""
    return F.format_string(fmt, *[_c(c) for c in cols])


def bucket_start(ts: Column | str, size: str) -> Column:
    """Start of the epoch-aligned bucket of ``size`` holding ``ts``
    (floors, so times before 1970 are bucketed correctly)."""
    return F.window(_c(ts), size).start
