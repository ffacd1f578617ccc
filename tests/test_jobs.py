"""Dashboard jobs end to end over a replayed message stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickpulse.plans import jobs
from clickpulse.sources import sinks
from clickpulse.sources.testdata import raw_messages
from conftest import SF001

EVENT = jobs.JobSettings(time="event", watermark="0 seconds", member_width="3 hours", item_width="3 hours",
                         cat_size="60 hours", cat_slide="10 hours", province_width="10 hours")


@pytest.fixture(scope="module")
def message_dir(spark):
    from clickpulse.session import scratch_path

    path = scratch_path(spark, "test", "messages")
    raw_messages(spark, SF001).write.parquet(path)
    return path


def stream(spark, path):
    return spark.readStream.schema("event_id bigint, value string").parquet(path)


def test_append_emits_each_closed_window_once(spark, scratch, message_dir):
    messages = spark.read.parquet(message_dir)
    last = jobs.timed_events(messages, "member_total", EVENT).agg(F.max("event_time")).collect()[0][0].replace(tzinfo=None)
    for name in ("member_total", "item_total"):
        job, out = jobs.JOBS[name], scratch(name)
        shape = lambda b, i, fold=job.fold: fold(b)
        q = jobs.start_job(job.build(stream(spark, message_dir), EVENT), f"t_{name}", sinks.fan_out(sinks.parquet(out), shape=shape),
                           checkpoint=scratch("ckpt"), available_now=True)
        q.awaitTermination()
        got = spark.read.parquet(out).drop("query_id", "batch_id")
        want = job.build(messages, EVENT).filter(F.col("window_end") <= F.lit(last))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
        assert got.count() > 200


def test_all_dashboards_and_rejects(spark, scratch, message_dir):
    outs, bad = {}, {}

    def writer(table):
        outs[table] = scratch(table)
        return sinks.parquet(outs[table])

    def rejects(job):
        bad[job] = scratch(f"rejects_{job}")
        return sinks.parquet(bad[job])

    running = jobs.start_dashboards(stream(spark, message_dir), writer, EVENT, rejects, scratch("ckpts"))
    try:
        assert len(running.queries) == 8
        for q in running.queries.values():
            q.processAllAvailable()
    finally:
        running.stop()
    for table, path in outs.items():
        df = spark.read.parquet(path)
        assert df.count() > 0
        assert df.columns[: len(sinks.SINK_TABLES[table][0])] == sinks.SINK_TABLES[table][0]
    messages = spark.read.parquet(message_dir)
    for job, path in bad.items():
        assert spark.read.parquet(path).count() == jobs.job_rejects(messages, job, EVENT).count() > 0


def broken_after(src, spark, failures):
    """A writer that fails its first calls, and the rows it wrote."""
    seen = {"calls": 0, "rows": 0}

    def write(batch, batch_id):
        seen["calls"] += 1
        if seen["calls"] <= failures:
            raise RuntimeError("boom")
        seen["rows"] += batch.count()

    return write, seen


def test_run_with_restarts_on_a_real_query(spark, scratch, message_dir):
    write, seen = broken_after(message_dir, spark, 2)
    ckpt = scratch("restart_ckpt")
    start = lambda: jobs.start_job(stream(spark, message_dir), "t_restart", write, checkpoint=ckpt, available_now=True)
    jobs.run_with_restarts(start, attempts=3, delay_s=0)
    assert seen == {"calls": 3, "rows": spark.read.parquet(message_dir).count()}
    write, seen = broken_after(message_dir, spark, 9)
    ckpt = scratch("restart_ckpt")
    with pytest.raises(Exception, match="boom"):
        jobs.run_with_restarts(start, attempts=1, delay_s=0)
    assert seen["calls"] == 2


def test_one_failing_job_leaves_the_others_running(spark, scratch, message_dir):
    good = scratch("good")

    def writer(table):
        if table == "realtime_member_total":
            return broken_after(message_dir, spark, 99)[0]
        return sinks.parquet(good)

    s = jobs.JobSettings(time="event", watermark="0 seconds", province_width="10 hours", member_width="3 hours")
    running = jobs.start_dashboards(stream(spark, message_dir), writer, s, checkpoint_root=scratch("ckpts"),
                                    only=["member_total", "province_window"], attempts=1, delay_s=0)
    try:
        running._threads[0].join(60)
        assert list(running.errors) == ["member_total"]
        running.queries["province_window"].processAllAvailable()
        assert running.queries["province_window"].isActive and spark.read.parquet(good).count() > 0
    finally:
        running.stop()


def test_settings_are_checked(spark, message_dir):
    assert jobs.province_job(stream(spark, message_dir)).isStreaming
    with pytest.raises(ValueError, match="time must be"):
        jobs.timed_events(stream(spark, message_dir), "member_total", jobs.JobSettings(time="bogus"))
    with pytest.raises(ValueError, match="watermark"):
        jobs.timed_events(stream(spark, message_dir), "member_total", jobs.JobSettings(time="event"))


def test_native_parquet_sink_is_exactly_once_on_restart(spark, scratch, message_dir):
    out, ckpt = scratch("native_out"), scratch("native_ckpt")
    for _ in range(2):  # the second start finds nothing new in the checkpoint
        q = sinks.parquet_stream(jobs.member_job(stream(spark, message_dir), EVENT), out, ckpt, available_now=True)
        q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == got.select("window_start").distinct().count() > 200
