"""Stream fixtures (FIXTURES section 4): in order, late, restart, append subset."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickpulse.operators.windows import member_total, province_window
from clickpulse.sources.testdata import read_table, user_behavior
from clickpulse.streaming.replay import read_update_log, replay_events, run_to_table, shuffled_replay, stream_view
from conftest import SF01


def split_events(spark, path, reverse=False):
    """events split by event_id range into 4 files named so they are read in order."""
    ev = read_table(spark, SF01, "events")
    bounds = [0, 2500, 5000, 7500, 10**9]
    parts = list(range(4))
    for n, i in enumerate(reversed(parts) if reverse else parts):
        chunk = ev.filter((F.col("event_id") >= bounds[i]) & (F.col("event_id") < bounds[i + 1]))
        chunk.coalesce(1).write.parquet(f"{path}/f{n}")
    return [f"{path}/f{n}" for n in range(4)]


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_in_order_replay_equals_batch(spark, scratch):
    src = scratch("in_order")
    split_events(spark, src)
    events = replay_events(spark, src, pattern="f*/*.parquet", max_files_per_trigger=1)
    got = run_to_table(province_window(stream_view(spark, SF01, events), width="10 hours"), "t_prov", ["province", "window_start"])
    want = province_window(user_behavior(spark, SF01), width="10 hours")
    assert as_set(got) == as_set(want)


def test_files_in_reverse_order_lose_nothing(spark, scratch):
    src = scratch("late")
    split_events(spark, src, reverse=True)
    events = replay_events(spark, src, pattern="f*/*.parquet", max_files_per_trigger=1)
    got = run_to_table(member_total(stream_view(spark, SF01, events), width="3 hours"), "t_late", ["window_start"])
    assert as_set(got) == as_set(member_total(user_behavior(spark, SF01), width="3 hours"))


def test_registered_replays_are_out_of_order_and_in_several_batches(spark):
    events = shuffled_replay(spark, SF01)
    seen = []
    q = events.writeStream.foreachBatch(lambda b, i: seen.append(b.agg(F.min("ts"), F.max("ts"), F.count("*")).first()))
    q.trigger(availableNow=True).start().awaitTermination()
    assert len(seen) >= 3 and sum(r[2] for r in seen) == read_table(spark, SF01, "events").count()
    assert all(a[0] < b[1] and b[0] < a[1] for a, b in zip(seen, seen[1:]))


def test_a_missing_log_is_empty_and_an_unreadable_one_fails(spark, scratch):
    import os

    df = spark.range(3)
    assert read_update_log(spark, scratch("none"), df, ["id"]).collect() == []
    bad = scratch("bad") + "/batch_id=0"
    os.makedirs(bad)
    with open(bad + "/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception, match="not a Parquet file|CANNOT_READ"):
        read_update_log(spark, bad.rsplit("/", 1)[0], df, ["id"]).collect()


def test_restart_from_checkpoint(spark, scratch):
    src, ckpt, out = scratch("restart_src"), scratch("restart_ckpt"), scratch("restart_out")
    files = split_events(spark, scratch("restart_all"))
    import shutil

    for f in files[:2]:
        shutil.copytree(f, f"{src}/{f.rsplit('/', 1)[-1]}")
    def run():
        ev = replay_events(spark, src, pattern="f*/*.parquet", max_files_per_trigger=1)
        return run_to_table(member_total(stream_view(spark, SF01, ev), width="3 hours"), "t_rs", ["window_start"], checkpoint=ckpt, out=out)

    first = run()
    n_first = first.agg(F.sum("click_count")).collect()[0][0]
    for f in files[2:]:
        shutil.copytree(f, f"{src}/{f.rsplit('/', 1)[-1]}")
    second = run()
    want = member_total(user_behavior(spark, SF01), width="3 hours")
    assert as_set(second) == as_set(want)
    assert n_first < second.agg(F.sum("click_count")).collect()[0][0]
