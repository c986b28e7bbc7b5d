"""Flatten counts, join key, empty maps, writer and the incremental driver."""

import os

from pyspark.sql import functions as F

from channelmart.plans.events import flatten_events, run_flatten_events, tag_events, write_events
from channelmart.sources import standins as si
from channelmart.streaming import flatten_new_events

SF = "/root/testdata/sf0.001"


def test_flatten_row_count_is_sum_of_map_sizes(spark):
    ev = si.events(spark, SF)
    flat = flatten_events(ev, "1", "p")
    assert flat.count() == ev.select(F.sum(F.size("event_params"))).first()[0]
    assert flat.where("event_name = 'error'").count() == 0
    assert set(flat.columns) >= {"event_params", "property_id", "property_name", "join_key", "key",
                                 "string_value", "int_value", "float_value", "double_value"}


def test_join_key_skips_null_user(spark):
    df = spark.createDataFrame([("e", 5, None), ("e", 5, "u")],
                               "event_name string, event_timestamp bigint, user_pseudo_id string")
    keys = [r.join_key for r in tag_events(df, "1", "p").collect()]
    assert keys == ["e_5", "e_5_u"]


def _same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_batch_write_is_idempotent(spark, scratch):
    flat = flatten_events(si.events(spark, SF), "1", "p")
    out = os.path.join(scratch, "flat")
    write_events(flat, out)
    write_events(flat, out)                                  # rewrite: same rows, no doubles
    assert spark.read.parquet(out).count() == flat.count()


def test_incremental_runs_keep_every_file_once(spark, scratch):
    """Files of one day land across two runs (and a run is repeated with
    nothing new): the stream output holds every flattened row exactly once."""
    ev = si.events(spark, SF)
    src = os.path.join(scratch, "landed")
    out = os.path.join(scratch, "flat_stream")
    ckpt = os.path.join(scratch, "ckpt")
    cols = [c for c in flatten_events(ev, "1", "p").columns if c != "event_params"]
    ev.where("event_date < '20240110' or (event_date = '20240110' and event_id % 2 = 0)") \
        .write.mode("append").parquet(src)
    flatten_new_events(spark, src, ev.schema, out, "1", "p", ckpt)
    first = spark.read.parquet(out).count()
    ev.where("event_date > '20240110' or (event_date = '20240110' and event_id % 2 = 1)") \
        .write.mode("append").parquet(src)
    flatten_new_events(spark, src, ev.schema, out, "1", "p", ckpt, max_files_per_trigger=1)
    flatten_new_events(spark, src, ev.schema, out, "1", "p", ckpt)          # nothing new
    got = spark.read.parquet(out)
    want = flatten_events(ev, "1", "p")
    assert 0 < first < want.count()
    assert got.count() == want.count()
    assert _same_rows(got.select(*cols), want.select(*cols))


def test_run_flatten_shuffles_events_before_the_explode(spark, scratch):
    """C6 job: same rows as the flattening, written once; the shuffle moves
    events (one row each), and the explode runs after it."""
    from channelmart.plans.events import _explode_params
    ev = si.events(spark, SF)
    out = os.path.join(scratch, "flat_job")
    run_flatten_events(ev, "1", "p", out)
    run_flatten_events(ev, "1", "p", out)                   # rerun: replaced, not doubled
    want = flatten_events(ev, "1", "p")
    cols = [c for c in want.columns if c != "event_params"]
    assert _same_rows(spark.read.parquet(out).select(*cols), want.select(*cols))
    plan = _explode_params(tag_events(ev, "1", "p").hint("rebalance", "property_id", "event_date")) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode") < plan.index("REBALANCE_PARTITIONS_BY_COL")


def test_two_sessions_share_the_progress(spark, scratch):
    """A second session of the same progress folder goes on where the first
    ended; without a folder the job does not start."""
    import subprocess
    import sys
    ev = si.events(spark, SF)
    src, out, ckpt = (os.path.join(scratch, d) for d in ("landed2", "flat2", "ckpt2"))
    code = (f"import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})\n"
            "from channelmart.session import local_session\nfrom channelmart.streaming import flatten_new_events\n"
            "from pyspark.sql.types import StructType\nimport json\n"
            "spark = local_session(cores=2, shuffle_partitions=2)\n"
            f"flatten_new_events(spark, {src!r}, StructType.fromJson(json.loads({ev.schema.json()!r})), {out!r}, '1', 'p', {ckpt!r})\n")
    for part in (0, 1):
        ev.where(f"event_id % 2 = {part}").coalesce(1).write.mode("append").parquet(src)
        subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    assert spark.read.parquet(out).count() == flatten_events(ev, "1", "p").count()
    import pytest
    with pytest.raises(TypeError):
        flatten_new_events(spark, src, ev.schema, out, "1", "p")


def test_parameters_as_an_array_keep_repeated_keys(spark):
    from channelmart.plans.events import flatten_events
    value = "struct<string_value:string,int_value:bigint,float_value:double,double_value:double>"
    rows = [(1, [("k", (None, 1, None, None)), ("s", ("x", None, None, None)), ("k", (None, 2, None, None))]), (2, []), (3, None), (4, [("d", (None, None, None, 0.5))])]
    df = spark.createDataFrame([("e", r, "20240101", "u", p) for r, p in rows],
                               f"event_name string, event_timestamp bigint, event_date string, user_pseudo_id string, event_params array<struct<key:string,value:{value}>>")
    got = sorted((r.event_timestamp, r.param_pos, r.key, r.string_value, r.int_value, r.double_value) for r in flatten_events(df, "1", "p").collect())
    assert got == [(1, 0, "k", None, 1, None), (1, 1, "s", "x", None, None), (1, 2, "k", None, 2, None), (4, 0, "d", None, None, 0.5)]


def test_the_written_events_are_read_by_partition(spark, scratch):
    """The library's own table by (property, day) gives a day by its folder."""
    import os
    from channelmart.plans.events import write_events
    from channelmart.sources import standins as si
    from channelmart.sources.tables import read_events_day
    path = os.path.join(scratch, "events")
    source = si.events(spark, "/root/testdata/sf0.001").withColumn("property_id", F.lit("7"))
    write_events(source, path)
    day = read_events_day(spark, path, "20240129")
    assert day.count() == source.where("event_date = '20240129'").count() > 0
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0] and "20240129" in plan
