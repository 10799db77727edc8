"""Side outputs and counters.

A multi-output operator returns one DataFrame whose rows carry a ``kind``
tag; ``split`` gives one DataFrame per tag.  In a stream, ``router`` is a
``foreachBatch`` function that persists the micro-batch once and writes each
kind to its own sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairo.functions.scalar import message


def route(df: DataFrame, outputs: dict[str, tuple[Column | None, dict[str, Column]]]) -> DataFrame:
    """Tagged multi-output: for each ``kind`` a predicate (``None`` = all
    rows) and a projection.  Columns missing in a projection are null."""
    columns = list(dict.fromkeys(n for _, proj in outputs.values() for n in proj))
    rows = []
    for kind, (pred, proj) in outputs.items():
        row = F.struct(F.lit(kind).alias("kind"), *[
            proj.get(n, F.lit(None)).alias(n) for n in columns])
        rows.append(row if pred is None else F.when(pred, row))
    # one array of tagged rows per input row: the input is read once
    return (df.select(F.explode(F.array_compact(F.array(*_typed(df, rows)))).alias("_r"))
            .select("_r.*"))


def _typed(df: DataFrame, rows: list[Column]) -> list[Column]:
    """Cast the tagged rows to one type: each field's type is that of the
    first output that has it."""
    kinds = [df.select(r.alias("r")).schema["r"].dataType for r in rows]
    fields = []
    for i, f in enumerate(kinds[0].fields):
        known = [k.fields[i].dataType for k in kinds if k.fields[i].dataType != T.NullType()]
        fields.append(T.StructField(f.name, known[0] if known else T.NullType()))
    return [r.cast(T.StructType(fields)) for r in rows]


def split(routed: DataFrame) -> Callable[[str], DataFrame]:
    """``split(routed)(kind)`` → the rows of one output, without the tag."""
    return lambda kind: routed.filter(F.col("kind") == kind).drop("kind")


def freezing_monitor(df: DataFrame, *, key: str = "id", value: str = "temperature",
                     below: float = 32.0) -> DataFrame:
    """Every reading goes to ``main``; readings below ``below`` also give
    a ``side`` message ``Freezing Alarm for <id>``."""
    main = {c: F.col(c) for c in df.columns}
    side = {c: F.col(c) for c in (key, "ts", "seq") if c in df.columns}
    side["message"] = message("Freezing Alarm for %s", key)
    return route(df, {"main": (None, main), "side": (F.col(value) < F.lit(below), side)})


def router(sinks: dict[str, Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: persist the tagged micro-batch once, hand
    each kind to its sink, release."""
    def run(batch: DataFrame, epoch: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for kind, sink in sinks.items():
                sink(batch.filter(F.col("kind") == kind).drop("kind"), epoch)
        finally:
            batch.unpersist()
    return run


def observe_count(df: DataFrame, name: str = "alerts") -> tuple[DataFrame, Observation]:
    """A job-level counter of the rows flowing through ``df``; read
    ``obs.get[name]`` after an action on the returned DataFrame."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs
