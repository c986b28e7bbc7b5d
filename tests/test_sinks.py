"""Dynamic partition overwrite: idempotent, other days survive, empty writes nothing."""

import os

from pyspark.sql import functions as F

from channelmart.sinks.writers import read_partitions, write_partitions


def days(path):
    return sorted(d for d in os.listdir(path) if d.startswith("data_date="))


def test_overwrite_only_present_days(spark, scratch):
    path = os.path.join(scratch, "out")
    a = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "data_date string, v int")
    write_partitions(a, path, ["data_date"])
    b = spark.createDataFrame([("2024-01-02", 20), ("2024-01-03", 30)], "data_date string, v int")
    write_partitions(b, path, ["data_date"])
    write_partitions(b, path, ["data_date"])          # twice: no change
    got = sorted((r.data_date, r.v) for r in read_partitions(spark, path).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 20), ("2024-01-03", 30)]
    empty = b.where(F.lit(False))
    write_partitions(empty, path, ["data_date"])
    assert days(path) == ["data_date=2024-01-01", "data_date=2024-01-02", "data_date=2024-01-03"]
    assert read_partitions(spark, path).count() == 3


def test_hot_day_is_written_by_several_tasks(spark, scratch):
    """A day holding most rows is split across several files (tasks) by the
    rebalance before the write, not funnelled through one task; every row
    is written once."""
    path = os.path.join(scratch, "hot")
    df = spark.range(200000).selectExpr(
        "case when id % 10 < 8 then '2024-01-01' else '2024-01-02' end as data_date",
        "id", "sha2(cast(id as string), 256) as payload")
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        write_partitions(df, path, ["data_date"])
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    hot = [f for f in os.listdir(os.path.join(path, "data_date=2024-01-01")) if f.endswith(".parquet")]
    assert len(hot) > 1
    assert read_partitions(spark, path).count() == 200000


def test_cluster_session_needs_a_shared_checkpoint_folder():
    """Only local mode gets a machine-local checkpoint folder; a cluster
    session must name a shared one in spark.checkpoint.dir."""
    import pytest
    from channelmart.session import ensure_checkpoint_dir

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class Context:
        def __init__(self, master, configured):
            self.master, self.conf, self.dir = master, Conf(configured), None

        def getCheckpointDir(self):
            return self.dir

        def getConf(self):
            return self.conf

        def setCheckpointDir(self, d):
            self.dir = d

    class Session:
        def __init__(self, sc):
            self.sparkContext = sc

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session(Context("yarn", None)))
    assert ensure_checkpoint_dir(Session(Context("yarn", "hdfs://shared/ckpt"))) == "hdfs://shared/ckpt"
    assert ensure_checkpoint_dir(Session(Context("local[8]", None))).startswith("/tmp/")


def test_days_with_other_columns_are_read_together(spark, scratch):
    path = os.path.join(scratch, "wide")
    write_partitions(spark.createDataFrame([("2024-01-01", 1)], "data_date string, v int"), path, ["data_date"])
    write_partitions(spark.createDataFrame([("2024-01-02", 2, "x")], "data_date string, v int, w string"), path, ["data_date"])
    wanted = [("2024-01-01", 1, None), ("2024-01-02", 2, "x")]
    for df in (read_partitions(spark, path, merge=True), read_partitions(spark, path, "v int, w string, data_date string")):
        assert sorted((r.data_date, r.v, r.w) for r in df.collect()) == wanted


def test_a_run_deletes_what_it_staged(spark, scratch):
    """The run functions leave no staged files, also when they fail."""
    from channelmart.plans.item_revenue import run_item_revenue
    from channelmart.session import ensure_checkpoint_dir, stage, staged_run
    from channelmart.sources import standins as si
    shared = ensure_checkpoint_dir(spark).removeprefix("file:")
    report = si.item_revenue_report(spark, "/root/testdata/sf0.001")
    before = set(os.listdir(shared))
    summary = run_item_revenue(report, si.ads_properties(spark), os.path.join(scratch, "out"), "1998-03-11")
    assert set(os.listdir(shared)) == before and summary.count() > 0
    try:
        with staged_run(spark) as folder:
            assert stage(spark.range(3), "x").count() == 3
            assert os.listdir(folder.removeprefix("file:"))
            raise RuntimeError("stop")
    except RuntimeError:
        pass
    assert set(os.listdir(shared)) == before
    kept = stage(spark.range(3), "kept")
    assert kept.count() == 3 and len(set(os.listdir(shared)) - before) == 1


def test_bucketed_frames_join_without_an_exchange(spark):
    from channelmart.session import stage_bucketed
    a = stage_bucketed(spark.range(100).selectExpr("id % 10 as k", "id as j", "id as v"), "a", ["k", "j"])
    b = stage_bucketed(spark.range(100).selectExpr("id % 10 as k", "id as j", "-id as w"), "b", ["k", "j"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b, ["k", "j"])
        assert joined.count() == 100
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_workers_get_the_package(tmp_path):
    """A session started elsewhere, without the package on the workers' path."""
    import subprocess
    import sys
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {here!r})
from channelmart.session import local_session, ship
spark = local_session(2, 1)
ship(spark)
def each(batches):
    import channelmart.functions.dates as d
    for b in batches:
        yield b
assert spark.range(3).mapInArrow(each, "id long").count() == 3
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
