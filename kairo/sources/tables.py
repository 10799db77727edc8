"""Batch readers and the mapping of ``events`` onto sensor-style records.

``events`` (event_id, ts, user_id, event_type, value, props) is read as a
reading stream: ``user_id`` is the key, ``value`` the measurement and
``event_id`` the arrival order.  Only the projected columns reach the
Parquet scan (column pruning), and filters on them are pushed down.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kairo.schema import LEVEL_HIGH, LEVEL_LOW


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def readings(events: DataFrame, *, event_type: Column | None = None) -> DataFrame:
    """``events`` → (id, ts, temperature, seq[, event_type])."""
    df = events
    if event_type is not None:
        df = df.filter(event_type)
    return df.select(
        F.col("user_id").alias("id"),
        F.col("ts"),
        F.col("value").alias("temperature"),
        F.col("event_id").alias("seq"),
        F.col("event_type"),
    )


def levels_from_events(events: DataFrame, control_type: str = "error",
                       high_above: float = 80.0) -> DataFrame:
    """Un-keyed control stream (J2): rows of one event type become a level,
    HIGH when their value is above ``high_above``."""
    return (events.filter(F.col("event_type") == control_type)
            .select(F.col("ts"),
                    F.when(F.col("value") > high_above, F.lit(LEVEL_HIGH))
                     .otherwise(F.lit(LEVEL_LOW)).alias("level"),
                    F.col("event_id").alias("seq")))


def thresholds_from_events(events: DataFrame, control_type: str = "purchase",
                           remove_every: int = 5) -> DataFrame:
    """Keyed threshold updates (J3): rows of one event type set the key's
    threshold to their value; every ``remove_every``-th event id carries 0.0,
    which removes the threshold."""
    return (events.filter(F.col("event_type") == control_type)
            .select(F.col("user_id").alias("id"), F.col("ts"),
                    F.when(F.col("event_id") % remove_every == 0, F.lit(0.0))
                     .otherwise(F.col("value")).alias("threshold"),
                    F.col("event_id").alias("seq")))


def switches_from_events(events: DataFrame, control_type: str = "signup",
                         duration_ms: int = 2 * 24 * 3600 * 1000) -> DataFrame:
    """Keyed gate switches (J1): rows of one event type open the key's gate
    for ``duration_ms``."""
    return (events.filter(F.col("event_type") == control_type)
            .select(F.col("user_id").alias("id"), F.col("ts"),
                    F.lit(duration_ms).cast("long").alias("duration_ms"),
                    F.col("event_id").alias("seq")))
