"""Replay a table as a stream.

The reference's random generators are not rebuilt; a stream is a replay of
stored rows.  ``split_for_replay`` writes a table as ``n`` arrival slices
(contiguous ranges of the arrival column) into a folder, one commit per
slice, so a file stream with ``maxFilesPerTrigger`` replays them in arrival
order, one micro-batch per slice.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def split_for_replay(df: DataFrame, path: str, n_slices: int, *,
                     order: str = "seq") -> str:
    """Write ``df`` to ``path`` as ``n_slices`` files in arrival order, in one
    pass: the input is range-partitioned by ``order`` into one file each.  File
    streams read files by modification time, so the slices are then committed
    one after the other."""
    staged = df.repartitionByRange(n_slices, order).sortWithinPartitions(order)
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    staging = f"{path}-staging-{uuid.uuid4().hex}"
    staged.write.parquet(staging)
    at, to = jvm.org.apache.hadoop.fs.Path(staging), jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    fs.mkdirs(to)
    names = sorted(f.getPath().getName() for f in fs.listStatus(at)
                   if f.getPath().getName().startswith("part-"))
    # distinct times before now, so a later call's slices come after these
    begin = int(time.time() * 1000) - len(names)
    for i, name in enumerate(names):
        source = jvm.org.apache.hadoop.fs.Path(at, name)
        fs.setTimes(source, begin + i, -1)
        fs.rename(source, jvm.org.apache.hadoop.fs.Path(to, name))
    fs.delete(at, True)
    return path


def replay_stream(spark: SparkSession, path: str, schema: T.StructType, *,
                  files_per_trigger: int = 1, glob: str | None = None) -> DataFrame:
    """A streaming DataFrame over the Parquet files in ``path``."""
    reader = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)
