"""The chunked prefix scan equals the direct window, also for a hot key."""

import pytest
from pyspark.sql import functions as F

from kairo.plans.scan import Agg, prefix_scan, with_chunks
from conftest import SF001

def aggs():
    return [
    Agg("s", "sum", "value"),
    Agg("c", "count", F.when(F.col("value") > 50, 1)),
    Agg("mx", "max", "value"),
    Agg("mn", "min", "value", inclusive=False),
    Agg("f", "first", F.when(F.col("event_type") == "error", F.col("value"))),
    Agg("l", "last", F.when(F.col("event_type") == "error", F.col("value")), inclusive=False),
    ]
COLS = ["event_id", "s", "c", "mx", "mn", "f", "l"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).withColumn("s", F.round("s", 6)).collect())


@pytest.mark.parametrize("keys,chunk_rows", [(["user_id"], 20), ([], 700), (["hot"], 500)])
def test_chunked_equals_direct(spark, keys, chunk_rows):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    # "hot": one key holds 60% of all rows, the rest spread over 40 keys
    ev = ev.withColumn("hot", F.when(F.col("event_id") % 5 < 3, F.lit(0))
                               .otherwise(F.col("user_id") % 40 + 1))
    direct = prefix_scan(ev, keys, ["ts", "event_id"], aggs(), chunk_rows=None)
    chunked = prefix_scan(ev, keys, ["ts", "event_id"], aggs(), chunk_rows=chunk_rows)
    assert _rows(direct) == _rows(chunked)


def _sizes(chunks):
    return [r["n"] for r in chunks.rows.groupBy("_chunk").agg(F.count("*").alias("n")).collect()]


def test_hot_key_is_split(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn("k", F.lit(1))
    cut = with_chunks(ev, ["k"], ["ts", "event_id"], 1000)
    sizes = _sizes(cut)
    assert cut.slices and sum(sizes) == ev.count() and len(sizes) >= 10 and max(sizes) < 2000


def test_burst_is_split(spark):
    """90 % of all rows in one key, within three timestamps."""
    ev = spark.range(20_000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id") % 40).alias("k"),
        F.timestamp_seconds(F.when(F.col("id") % 10 > 0, F.col("id") % 3)
                            .otherwise(F.col("id"))).alias("ts"),
        (F.col("id") * 7919 % 101).cast("double").alias("value"),
        F.when(F.col("id") % 11 == 0, "error").otherwise("view").alias("event_type"))
    cut = with_chunks(ev, ["k"], ["ts", "event_id"], 1000)
    by = [r["n"] for r in cut.rows.groupBy("k", "_chunk").agg(F.count("*").alias("n")).collect()]
    assert max(by) <= 2000
    want = prefix_scan(ev, ["k"], ["ts", "event_id"], aggs(), chunk_rows=None)
    assert _rows(want) == _rows(prefix_scan(ev, ["k"], ["ts", "event_id"], aggs(), chunk_rows=1000))


def test_null_keys_are_a_key(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn(
        "k", F.when(F.col("event_id") % 3 == 0, F.col("user_id") % 5))
    want = prefix_scan(ev, ["k"], ["ts", "event_id"], aggs(), chunk_rows=None)
    assert _rows(want) == _rows(prefix_scan(ev, ["k"], ["ts", "event_id"], aggs(), chunk_rows=500))


def test_rows_are_dealt_once(spark):
    """Without broadcasts, the plan deals the full rows in one exchange."""
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn("hot", F.col("user_id") % 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = prefix_scan(ev, ["hot"], ["ts", "event_id"], aggs(), chunk_rows=500)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [x for x in plan.splitlines() if "Exchange " in x]
    rows = [x for x in dealt if "REPARTITION" in x]
    assert len(rows) == 1 and "_chunk" in rows[0]
    # the others move partial aggregates and the carry
    assert len([x for x in dealt if "hashpartitioning" in x and "REPARTITION" not in x]) <= 2


def test_no_hot_key_is_not_cut(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    assert with_chunks(ev, ["user_id"], ["ts", "event_id"], 10_000).slices == 0


def test_scan_without_keys_is_always_cut(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    sizes = _sizes(with_chunks(ev, [], ["event_id"], 10_000_000))
    assert len(sizes) >= 8 and max(sizes) < 0.3 * sum(sizes)


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]


def test_rows_are_never_dealt_by_the_bare_key(spark, monkeypatch):
    """Also where nothing beyond the bounds may be broadcast."""
    from kairo.plans import scan
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn("hot", F.col("user_id") % 3)
    want = _rows(prefix_scan(ev, ["hot"], ["ts", "event_id"], aggs(), chunk_rows=None))
    monkeypatch.setattr(scan, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = prefix_scan(ev, ["hot"], ["ts", "event_id"], aggs(), chunk_rows=500)
        dealt = _exchanges(out)
        assert _rows(out) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = [x for x in dealt if "event_type" in x or "REPARTITION" in x]
    assert len(rows) == 1 and "_chunk" in rows[0]
    # by the key alone go only the slices' summaries
    for x in dealt:
        assert "_chunk" in x or "REPARTITION" not in x


def test_slices_follow_each_keys_own_count(spark):
    """One huge key and many barely hot ones: bounds in all as the rows, not as the
    number of keys times the largest."""
    ev = spark.range(60_000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") < 40_000, 0).otherwise(F.col("id") % 100 + 1).alias("k"),
        F.timestamp_seconds(F.col("id") * 7).alias("ts"),
        (F.col("id") * 7919 % 101).cast("double").alias("value"),
        F.when(F.col("id") % 11 == 0, "error").otherwise("view").alias("event_type"))
    cut = with_chunks(ev, ["k"], ["ts", "event_id"], 150)
    by = {r["k"]: r["s"] for r in cut.rows.groupBy("k").agg(F.count_distinct("_chunk").alias("s"))
          .collect()}
    assert by[0] >= 256 and max(n for k, n in by.items() if k) <= 4
    assert cut.slices <= 2 * (512 + 100 * 2)
    want = prefix_scan(ev, ["k"], ["ts", "event_id"], aggs(), chunk_rows=None)
    assert _rows(want) == _rows(prefix_scan(ev, ["k"], ["ts", "event_id"], aggs(), chunk_rows=150))


def test_slices_grow_beyond_the_total(spark, monkeypatch):
    """With more rows than ``TOTAL_SLICES`` slices are for, slices grow, and results stay."""
    from kairo.plans import scan
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn("hot", F.col("user_id") % 3)
    want = _rows(prefix_scan(ev, ["hot"], ["ts", "event_id"], aggs(), chunk_rows=None))
    monkeypatch.setattr(scan, "TOTAL_SLICES", 10)
    cut = with_chunks(ev, ["hot"], ["ts", "event_id"], 20)
    assert 0 < cut.slices <= 2 * 3 * 8
    assert _rows(prefix_scan(ev, ["hot"], ["ts", "event_id"], aggs(), chunk_rows=20)) == want


def test_empty_frames(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet").filter("event_id < 0")
    for keys in (["user_id"], []):
        assert prefix_scan(ev, keys, ["ts", "event_id"], aggs()).count() == 0
