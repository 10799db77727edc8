"""Session construction and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kairo") -> SparkSession:
    """Return the active session or build a local one configured for kairo.

    On a cluster the session already exists and its settings win; the
    builder options below only apply when a fresh local session is created
    (tests, bench).
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and streaming checkpoints.

    ``spark.checkpoint.dir`` if the cluster sets it, else the folder the
    user's context already has.  Only a local master without either gets a
    fresh scratch folder; any other master raises, because a machine-local
    folder would not be shared.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="kairo-ckpt-")
        sc.setCheckpointDir(folder)
        atexit.register(_delete_local, folder.removeprefix("file://"))
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def _delete_local(path: str) -> None:
    shutil.rmtree(path, ignore_errors=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


#: Rows of narrow tables that one scratch file holds.
ROWS_PER_FILE = 250_000


def materialize(df: DataFrame, name: str, *, compressed: bool = True,
                rows: int | None = None) -> tuple[DataFrame, int]:
    """Cut lineage: write ``df`` as Parquet into the shared checkpoint folder
    (one job; the row count comes from an observation on that job) and read
    it back.  The files survive executor loss; ``release`` deletes them.
    ``compressed=False`` suits hashes and ids, which do not compress, and
    spares the executors the codecs' direct buffers.  ``rows``, a known bound
    on the rows of a narrow table, keeps a small table from being written in
    many files."""
    spark = df.sparkSession
    if rows is not None:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.coalesce(max(1, min(parts, -(-rows // ROWS_PER_FILE))))
    path = scratch_path(spark, name)
    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(
        path, compression=None if compressed else "uncompressed")
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    for owner in _OWNERS:
        owner.paths.add(path)
    return out, int(obs.get["n"])


_WRITTEN: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def release(*frames: DataFrame) -> None:
    """Delete the files behind frames that ``materialize`` returned, once no
    later plan reads them."""
    for df in frames:
        path = _WRITTEN.pop(df, None)
        if path:
            _delete(df.sparkSession, path)
            for owner in _OWNERS:
                owner.paths.discard(path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


_OWNERS: list[Scratch] = []


class Scratch:
    """Owner of the tables that queries write on their way: those written inside the
    ``with`` block go at its end, also after an error.  Results are read from such
    tables, so write or collect them inside the block::

        with Scratch(spark):
            operators.rise_alert(readings).write.parquet(target)
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, set()

    def __enter__(self) -> Scratch:
        _OWNERS.append(self)
        return self

    def __exit__(self, *error) -> None:
        _OWNERS.remove(self)
        for path in self.paths:
            _delete(self.spark, path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that map
    functions import it there whatever the working folder is."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="kairo-zip-")
    atexit.register(_delete_local, folder)
    path = os.path.join(folder, "kairo.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
