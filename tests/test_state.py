"""Retained state that can be read. S1: the offset ledger. S3, J5: the feed as a stream. T3: panes of live windows."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from clickpulse.functions.events import parse_events
from clickpulse.operators.windows import cat_panes, cat_window, item_counts, item_rows
from clickpulse.plans import jobs
from clickpulse.plans.catalog import event_settings, user_log_lines
from clickpulse.sources import kafka, sinks
from clickpulse.sources.testdata import raw_messages, user_behavior
from clickpulse.streaming import state
from conftest import SF001

EVENT = event_settings(watermark="0 seconds")


def strings(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def message_dir(spark):
    from clickpulse.session import scratch_path

    path = scratch_path(spark, "test", "state_messages")
    raw_messages(spark, SF001).select("value").write.text(path)
    return path


def run(spark, message_dir, job, scratch, settings=EVENT):
    out, ckpt = scratch(f"{job}_rows"), scratch(f"{job}_ckpt")
    stream = spark.readStream.schema("value string").text(message_dir)
    q = jobs.start_job(jobs.JOBS[job].build(stream, settings), f"state_{job}", sinks.parquet(out), checkpoint=ckpt, available_now=True)
    q.awaitTermination()
    return out, ckpt, q


def test_open_windows_of_a_stopped_item_job(spark, message_dir, scratch):
    # A day's allowance keeps the windows of the last day open.
    settings = event_settings(watermark="1 day")
    out, ckpt, _ = run(spark, message_dir, "item_total", scratch, settings)
    events = jobs.timed_events(spark.read.text(message_dir), "item_total", settings)
    counts = item_counts(events, width=settings.item_width)
    written = spark.read.parquet(out)
    keys = ["item_id", "action", "cat_id", "brand_id", "window_start"]
    left = counts.join(written.select("window_start").distinct(), "window_start", "left_anti")
    held = state.open_windows(spark, ckpt, ["item_id", "action", "cat_id", "brand_id"], ["n"])
    assert strings(held.select(*counts.columns)) == strings(left.select(*counts.columns))
    assert held.count() > 10 and written.count() > 100
    assert held.select(*keys).distinct().count() == held.count()
    # What was written and what is held make up the batch result.
    both = item_rows(written.select(*counts.columns).unionByName(held.select(*counts.columns)))
    assert strings(both) == strings(item_rows(counts))
    assert strings(state.open_items(spark, ckpt)) == strings(item_rows(left))
    assert state.operators(spark, ckpt).count() == 1
    with pytest.raises(ValueError, match="keys"):
        state.open_windows(spark, ckpt, ["item_id"], ["n"])


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(query) -> list[str]:
    """The lines of the plan that a stopped query ran last, results first."""
    return query._jsq.explainInternal(False).splitlines()


def test_live_sliding_windows_come_from_panes(spark, message_dir, scratch):
    out, ckpt, q = run(spark, message_dir, "cat_window", scratch)
    messages = spark.read.text(message_dir)
    events = jobs.timed_events(messages, "cat_window", EVENT)
    batch = cat_window(events, size=EVENT.cat_size, slide=EVENT.cat_slide)
    # Spark moves the click filter below the watermark, so the last click sets it.
    last = events.where("action_code = 0").agg(F.max("event_time")).first()[0].replace(tzinfo=None)
    closed = batch.where(F.col("window_end") <= F.lit(last))
    got = spark.read.parquet(out).select(*batch.columns)
    assert strings(got) == strings(closed) and got.count() > 100
    # Two aggregations; the first keeps one row per category and pane and no event is multiplied before it.
    plan = executed(q)
    saves = [i for i, line in enumerate(plan) if "StateStoreSave" in line]
    expands = [i for i, line in enumerate(plan) if re.search(r"\bExpand\b", line)]
    assert len(saves) == 2 and expands and all(saves[0] < i < saves[1] for i in expands)
    panes = state.state_rows(spark, ckpt, operator=1)
    assert state.operators(spark, ckpt).count() == 2
    held = cat_panes(events, slide=EVENT.cat_slide).where(F.col("window_end") > F.lit(last))
    assert panes.count() == held.count() > 0
    # Spark's own sliding window, for any other slide, multiplies the events.
    stream = spark.readStream.schema("value string").text(message_dir)
    direct = cat_window(jobs.timed_events(stream, "cat_window", EVENT), size="60 hours", slide="10 hours", panes=False)
    q = jobs.start_job(direct, "state_direct", lambda b, i: b.count(), checkpoint=scratch("direct"), available_now=True)
    q.awaitTermination()
    plan = executed(q)
    saves = [i for i, line in enumerate(plan) if "StateStoreSave" in line]
    expands = [i for i, line in enumerate(plan) if re.search(r"\bExpand\b", line)]
    assert len(saves) == 1 and min(expands) > saves[0]


def test_offset_ledger(spark, scratch):
    path = scratch("ledger")
    ledger = kafka.OffsetLedger(spark, path)
    assert ledger.committed() == {} and kafka.starting_offsets({}) == "latest"
    assert kafka.starting_offsets({}, otherwise=kafka.EARLIEST) == "earliest"

    def batch(rows):
        return spark.createDataFrame(rows, "value string, partition int, offset long")

    written = []
    write = ledger.after(lambda b, i: written.append((i, b.count())))
    write(batch([("a", 0, 5), ("b", 0, 7), ("c", 1, 100)]), 0)
    write(batch([("d", 1, 101)]), 1)
    write(batch([("d", 1, 101)]), 1)  # runs again
    write(batch([]), 2)
    assert ledger.committed() == {0: 8, 1: 102} and written == [(0, 3), (1, 1), (1, 1), (2, 0)]

    def broken(b, i):
        raise RuntimeError("not written")

    with pytest.raises(RuntimeError):
        ledger.after(broken)(batch([("e", 0, 900)]), 3)
    assert ledger.committed() == {0: 8, 1: 102}  # only what has been written counts
    start = kafka.starting_offsets(ledger.committed(), "t", partitions=[0, 1, 2])
    assert json.loads(start) == {"t": {"0": 8, "1": 102, "2": -1}}
    early = kafka.starting_offsets(ledger.committed(), "t", [2], kafka.EARLIEST)
    assert json.loads(early)["t"]["2"] == -2
    options = kafka.kafka_source_options("b:1", "t", starting_offsets=start)
    assert json.loads(options["startingOffsets"])["t"]["0"] == 8
    with pytest.raises(ValueError):
        kafka.starting_offsets({}, otherwise=0)


def test_feed_stopped_in_the_middle_repeats_and_loses_nothing(spark, scratch):
    log, out, ckpt = scratch("feed_log"), scratch("feed_out"), scratch("feed_ckpt")
    lines = user_log_lines(spark, SF001).persist()
    for part in range(3):
        lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == part).coalesce(1).write.mode("append").text(log)
        q = jobs.start_feed(spark, log, out, ckpt, available_now=True)
        q.awaitTermination()
    jobs.start_feed(spark, log, out, ckpt, available_now=True).awaitTermination()  # nothing new
    # Files of an attempt that broke off before its commit are not read.
    spark.createDataFrame([('{"action":"0"}',)], "value string").coalesce(1).write.mode("append").text(f"{out}/stray")
    got = parse_events(spark.read.schema("value string").text(out)).drop("event_ms")
    want = parse_events(jobs.feed_job(spark, log)).drop("event_ms")
    assert strings(got) == strings(want) and got.count() == lines.count()


def test_balance_is_one_pass(spark):
    messages = raw_messages(spark, SF001)
    reads = []
    real = jobs.job_metric

    def watched(events, job, s):
        out = real(events, job, s)
        reads.append(optimized(out).count("event_type#") and out._jdf.queryExecution().executedPlan().toString())
        return out

    jobs.job_metric = watched
    try:
        for job in jobs.JOBS:
            row = jobs.job_balance(messages, job, EVENT).first()
            assert row.messages == user_behavior(spark, SF001).count() == row.accepted + row.rejected
            assert 0 < row.counted <= row.accepted
    finally:
        jobs.job_metric = real
    for plan in reads:
        initial = plan.split("Initial Plan")[0]
        assert len(re.findall(r"FileScan parquet \[event_id", initial)) == 1 and "from_json" in initial
        assert initial.count("from_json(") == 1


def test_a_stream_reports_its_balance(spark, message_dir, scratch):
    stream = spark.readStream.schema("value string").text(message_dir)
    events = jobs.timed_events(stream, "member_total", EVENT, observation="balance")
    q = jobs.start_job(jobs.job_metric(events, "member_total", EVENT), "observed", sinks.parquet(scratch("o")),
                       checkpoint=scratch("c"), available_now=True)
    q.awaitTermination()
    seen = [p.observedMetrics["balance"] for p in q.recentProgress if "balance" in p.observedMetrics]
    total = spark.read.text(message_dir).count()
    rejected = jobs.job_rejects(spark.read.text(message_dir), "member_total", EVENT).count()
    assert sum(r["messages"] for r in seen) == total and sum(r["rejected"] for r in seen) == rejected > 0
