import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from kairo.session import ROCKSDB_PROVIDER
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kairo-test-ckpt-"))
         .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from kairo.session import checkpoint_dir
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def small_chunks(spark):
    """Force the chunked (hot-key) path of the prefix scan."""
    from kairo.plans.scan import CHUNK_ROWS_CONF
    spark.conf.set(CHUNK_ROWS_CONF, "7")
    yield
    spark.conf.unset(CHUNK_ROWS_CONF)
