"""Sessions and the checkpoint folder, each in a Spark of its own."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

RISE = """
from kairo import operators as op
from kairo.session import checkpoint_dir, get_session, materialize, release
{make}
ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
    "user_id AS id", "ts", "value AS temperature", "event_id AS seq")
print("ROWS", op.rise_alert(ev, hold="1 day").count())
df, n = materialize(spark.range(5), "t")
files = df.inputFiles()
release(df)
import os
print("GONE", n, not any(os.path.exists(f.removeprefix("file:").replace("//", "/")) for f in files))
print("DIR", checkpoint_dir(spark))
"""


def run(tmp_path, make: str) -> dict[str, str]:
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_"))}
    conf = tmp_path / "conf"
    conf.mkdir()
    out = subprocess.run([sys.executable, "-c", RISE.format(make=make)], cwd=ROOT, timeout=300,
                         env=env | {"SPARK_CONF_DIR": str(conf), "PYTHONPATH": ROOT},
                         capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    return dict(line.split(" ", 1) for line in out.stdout.splitlines() if line[:4] in ("ROWS", "GONE", "DIR "))


def test_stock_spark(tmp_path):
    got = run(tmp_path, "spark = get_session(master='local[2]', shuffle_partitions=2)")
    assert int(got["ROWS"]) > 0 and got["GONE"] == "5 True"


def test_own_checkpoint_folder_is_kept(tmp_path):
    own = tmp_path / "own"
    got = run(tmp_path, f"""
spark = get_session(master='local[2]', shuffle_partitions=2)
spark.sparkContext.setCheckpointDir("{own}")
""")
    assert str(own) in got["DIR"] and got["GONE"] == "5 True"


def test_scratch_owner_deletes_what_queries_wrote(spark):
    from kairo import operators as op
    from kairo.sources.tables import readings
    from kairo.session import Scratch, checkpoint_dir
    from conftest import SF0001

    def tables():
        folder = checkpoint_dir(spark).removeprefix("file://")
        return {n for n in os.listdir(folder) if n.startswith(("rise-", "scan-"))}

    before = tables()
    r = readings(spark.read.parquet(f"{SF0001}/events.parquet"))
    with Scratch(spark):
        with Scratch(spark):
            assert op.rise_alert(r, hold="1 day").count() > 0
            assert tables() > before
        assert tables() == before
    try:
        with Scratch(spark):
            op.rise_alert(r, hold="1 day")
            raise KeyError
    except KeyError:
        pass
    assert tables() == before
