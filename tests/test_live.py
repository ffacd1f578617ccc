"""Idle fixture (FIXTURES section 4): one file, then nothing.

In arrival time the last window must wait for more input; with the clock it must
come without, with every event counted once.
"""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from clickpulse.plans import jobs
from clickpulse.sources import sinks
from clickpulse.sources.testdata import raw_messages
from conftest import SF001

CLOCK = jobs.JobSettings(time="clock", member_width="3 seconds", item_width="3 seconds", cat_size="3 seconds",
                         cat_slide="1 second", province_width="3 seconds")
WIDE = jobs.JobSettings(time="processing", member_width="3650 days", item_width="3650 days", cat_size="3650 days",
                        cat_slide="3650 days", province_width="3650 days")


@pytest.fixture(scope="module")
def one_file(spark):
    from clickpulse.session import scratch_path

    path = scratch_path(spark, "test", "idle_src")
    raw_messages(spark, SF001).coalesce(1).write.parquet(path)
    return path


def messages(spark, path):
    return spark.readStream.schema("event_id bigint, value string").parquet(path)


def test_arrival_time_waits_for_more_input(spark, scratch, one_file):
    out = scratch("default_out")
    s = jobs.JobSettings(member_width="3 seconds")
    q = jobs.start_job(jobs.member_job(messages(spark, one_file), s), "t_idle_default", sinks.parquet(out), s, scratch("ckpt"))
    try:
        q.processAllAvailable()
        time.sleep(8)
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == 0


def test_clock_closes_windows_of_all_jobs_while_idle(spark, scratch, one_file):
    outs = {}

    def writer(table):
        outs[table] = scratch("live_" + table)
        return sinks.parquet(outs[table])

    batch = spark.read.parquet(one_file)
    want = {job.table: sinks.sink_rows(job.build(batch, WIDE), job.table) for job in jobs.JOBS.values()}
    drop = ["time", "window_start", "window_end", "query_id", "batch_id"]
    want = {t: sorted(map(str, df.drop(*drop).collect())) for t, df in want.items()}
    # One micro-batch of input lands in one second: it is in three windows of 3 s that slide by 1 s.
    want["realtime_cat_window"] = sorted(want["realtime_cat_window"] * 3)
    running = jobs.start_dashboards(messages(spark, one_file), writer, CLOCK, checkpoint_root=scratch("live_ckpts"))
    got = {}
    try:
        end = time.time() + 120
        while time.time() < end and got != want:
            time.sleep(2)
            for table, path in outs.items():
                try:
                    df = spark.read.parquet(path)
                except Exception:  # noqa: BLE001 - nothing written yet
                    continue
                got[table] = sorted(map(str, df.drop(*drop).collect()))
    finally:
        running.stop()
    assert running.errors == {} and got == want
    for table, width in (("realtime_member_total", 3), ("realtime_cat_window", 3)):
        spans = spark.read.parquet(outs[table]).select("window_start", "window_end").distinct().collect()
        assert {(r.window_end - r.window_start).total_seconds() for r in spans} == {width}
        assert len(spans) == (3 if table == "realtime_cat_window" else 1)
    # Nothing comes twice: as many rows as wanted, each key and window once.
    cats = spark.read.parquet(outs["realtime_cat_window"])
    assert cats.groupBy("cat_id", "window_start").count().agg(F.max("count")).collect()[0][0] == 1
