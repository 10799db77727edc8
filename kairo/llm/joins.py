"""A lookup join that no hot key can bring down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairo.session import materialize

#: Keys that are broadcast: those with the most rows.
HOT_KEYS = 4096


def lookup(rows: DataFrame, table: DataFrame, on: list[str], weight: str,
           keys: int = HOT_KEYS) -> DataFrame:
    """``rows`` with the columns of ``table`` (one row a key; null keys are equal),
    keys without a table row left out.  ``weight``, a column of ``table``, counts
    the rows that ask for the key.  The ``keys`` heaviest keys, a fixed number, are
    broadcast, so their rows stay where they are; any other key has at most
    ``1 / keys`` of the rows and is joined by a shuffle.  Both frames are read
    twice: pass written tables.  Column names of ``table`` other than the key must
    not occur in ``rows``."""
    table = table.withColumnsRenamed({c: f"_{c}" for c in on})
    heavy = table.orderBy(F.desc(weight), *[f"_{c}" for c in on]).limit(keys)
    heavy, n = materialize(heavy, "lookup-heavy", rows=keys)

    def same(a, b):
        cond = F.lit(True)
        for c in on:
            cond = cond & a[c].eqNullSafe(b[f"_{c}"])
        return cond

    drop = [f"_{c}" for c in on] + [weight]
    out = rows.join(F.broadcast(heavy), same(rows, heavy)).drop(*drop)
    if n < keys:                     # every key is among the heavy ones
        return out
    rest = rows.join(F.broadcast(heavy), same(rows, heavy), "left_anti")
    light = table.join(F.broadcast(heavy), [f"_{c}" for c in on], "left_anti")
    return out.unionByName(rest.join(light, same(rest, light)).drop(*drop))
