"""The dashboard jobs, composed from sources, metrics and sinks.

A job turns a stream of JSON messages into one metric stream. It reads only the fields
it needs, and what it cannot use goes to its reject feed (``job_rejects``), or fails it
in strict mode. Time is

* ``processing``: arrival, ``current_timestamp()``, one value per micro-batch. Windows close when
  later input arrives.
* ``clock``: arrival, and windows also close while input is idle (T7, ``streaming.live``).
* ``event``: the message's epoch milliseconds. A continuous run must name its watermark: events
  behind it are dropped. Messages without a time are rejects.

Append mode emits each window once. ``run_once`` processes what is there and writes every
window, the last ones included. Every query has its own checkpoint folder (T9) and name
(T11), and is started again from that checkpoint when it fails (T10), on its own.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpulse.functions.events import (
    ACTION,
    CATEGORY,
    PROVINCE,
    TIME,
    observed_events,
    parse_events,
    reject_events,
    to_messages,
)
from clickpulse.functions.timeutil import duration_us
from clickpulse.operators.windows import (
    cat_panes,
    cat_rows,
    cat_window,
    item_counts,
    item_rows,
    member_total,
    province_window,
)
from clickpulse.session import storage_root
from clickpulse.sources import sinks
from clickpulse.sources.userlog import read_user_log

TIMES = ("processing", "clock", "event")


@dataclass(frozen=True)
class JobSettings:
    time: str = "processing"  # or "clock", "event"
    watermark: str | None = None  # event time only
    trigger: str = "1 second"
    strict: bool = False
    member_width: str = "3 seconds"
    item_width: str = "3 seconds"
    cat_size: str = "60 seconds"
    cat_slide: str = "10 seconds"
    province_width: str = "10 seconds"


# What each job reads, and what a message must have to be counted. The item job takes any
# action: a missing or odd one is a group of its own with all counters zero.
JOB_FIELDS = {
    "member_total": ["action"],
    "item_total": ["item_id", "action", "cat_id", "brand_id"],
    "cat_window": ["cat_id", "action"],
    "province_window": ["province", "action"],
}
JOB_NEEDS = {
    "member_total": (ACTION,),
    "item_total": (),
    "cat_window": (ACTION, CATEGORY),
    "province_window": (ACTION, PROVINCE),
}


def job_needs(job: str, s: JobSettings = JobSettings()) -> tuple[str, ...]:
    return JOB_NEEDS[job] + ((TIME,) if s.time == "event" else ())


def job_events(
    messages: DataFrame, job: str, s: JobSettings = JobSettings(), observation: Observation | str | None = None
) -> DataFrame:
    """The job's parsed events (P1, P2, P10); ``observation`` gets the numbers of messages accepted and rejected."""
    fields = JOB_FIELDS[job] + (["event_ms"] if s.time == "event" else [])
    if observation is not None and not s.strict:
        return observed_events(messages, observation, needs=job_needs(job, s), fields=fields)
    return parse_events(messages, strict=s.strict, needs=job_needs(job, s), fields=fields)


def job_rejects(messages: DataFrame, job: str, s: JobSettings = JobSettings(), *keep: str) -> DataFrame:
    """The messages that the job does not count, and why."""
    return reject_events(messages, *keep, needs=job_needs(job, s))


def timed_events(
    messages: DataFrame,
    job: str,
    s: JobSettings = JobSettings(),
    bounded: bool = False,
    observation: Observation | str | None = None,
) -> DataFrame:
    """The job's events with ``event_time`` and, unless ``bounded``, a watermark on it."""
    events = job_events(messages, job, s, observation)
    if s.time not in TIMES:
        raise ValueError(f"time must be one of {', '.join(TIMES)}, not {s.time!r}")
    if s.time == "clock" and events.isStreaming and not bounded:
        from clickpulse.streaming.live import with_clock

        return with_clock(events)
    if s.time == "event":
        events = events.withColumn("event_time", F.timestamp_millis(F.col("event_ms")))
        if bounded or not events.isStreaming:
            return events
        if s.watermark is None:
            raise ValueError("event time needs a watermark: how late an event may come before it is dropped")
        return events.withWatermark("event_time", s.watermark)
    events = events.withColumn("event_time", F.current_timestamp())  # P5
    return events if bounded else events.withWatermark("event_time", "0 seconds")


def job_metric(events: DataFrame, job: str, s: JobSettings = JobSettings()) -> DataFrame:
    """The metric of a job over its events."""
    if job == "member_total":
        return member_total(events, width=s.member_width)
    if job == "item_total":
        counts = item_counts(events, width=s.item_width)
        return counts if counts.isStreaming else item_rows(counts)
    if job == "cat_window":
        return cat_window(events, size=s.cat_size, slide=s.cat_slide)
    return province_window(events, width=s.province_width)


def member_job(messages: DataFrame, s: JobSettings = JobSettings()) -> DataFrame:
    """Site-wide action counts per tumbling window."""
    return job_metric(timed_events(messages, "member_total", s), "member_total", s)


def item_job(messages: DataFrame, s: JobSettings = JobSettings()) -> DataFrame:
    """Per-item counts per tumbling window.

    A stream emits the counts of all id combinations of a window at once; each emitted batch is
    folded by ``item_rows`` before it is written.
    """
    return job_metric(timed_events(messages, "item_total", s), "item_total", s)


def cat_job(messages: DataFrame, s: JobSettings = JobSettings()) -> DataFrame:
    """Clicks per category, sliding window."""
    return job_metric(timed_events(messages, "cat_window", s), "cat_window", s)


def province_job(messages: DataFrame, s: JobSettings = JobSettings()) -> DataFrame:
    """Per-province counts per tumbling window, with region codes."""
    return job_metric(timed_events(messages, "province_window", s), "province_window", s)


def job_balance(messages: DataFrame, job: str, s: JobSettings = JobSettings()) -> DataFrame:
    """One row: the messages of a job, those accepted and rejected, and what its counters add up to.

    One pass over the messages: the first three are counted on the way to the metric. An event counts once in
    every window that holds it, so the counters of sliding windows are divided by their number. Runs at once.
    """
    seen = Observation(f"{job}_balance")
    metric = job_metric(timed_events(messages, job, s, observation=seen), job, s)
    counters = [F.col(c) for c in metric.columns if c.endswith("_count")]
    windows = duration_us(s.cat_size) // duration_us(s.cat_slide) if job == "cat_window" else 1
    counted = metric.agg(F.coalesce(F.sum(sum(counters[1:], counters[0])), F.lit(0)).alias("n")).first()["n"]
    found = seen.get
    row = (found["messages"], found["accepted"], found["rejected"], counted // windows)
    names = "messages bigint, accepted bigint, rejected bigint, counted bigint"
    return messages.sparkSession.createDataFrame([row], names)


def _as_is(batch: DataFrame) -> DataFrame:
    return batch


@dataclass(frozen=True)
class Job:
    build: Callable[[DataFrame, JobSettings], DataFrame]
    table: str
    fold: Callable[[DataFrame], DataFrame] = _as_is  # of each emitted batch


JOBS: dict[str, Job] = {
    "member_total": Job(member_job, "realtime_member_total"),
    "item_total": Job(item_job, "realtime_item_total", item_rows),
    "cat_window": Job(cat_job, "realtime_cat_window"),
    "province_window": Job(province_job, "realtime_province_window"),
}


def job_checkpoint(spark: SparkSession, name: str, root: str | None = None) -> str:
    """One checkpoint folder per query, stable across restarts.

    A restart must use the same folder; a different source needs a new one.
    """
    return f"{(root or storage_root(spark) + '/clickpulse/jobs').rstrip('/')}/{name}"


def start_job(
    result: DataFrame,
    name: str,
    writer: sinks.BatchWriter,
    settings: JobSettings = JobSettings(),
    checkpoint: str | None = None,
    output_mode: str = "append",
    available_now: bool = False,
) -> StreamingQuery:
    """Start ``result`` as query ``name`` writing each micro-batch through ``writer``."""
    w = (
        result.writeStream.queryName(name)
        .outputMode(output_mode)
        .foreachBatch(writer)
        .option("checkpointLocation", checkpoint or job_checkpoint(result.sparkSession, name))
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=settings.trigger)
    return w.start()


def _shaper(name: str) -> Callable[[DataFrame, int], DataFrame]:
    job = JOBS[name]
    return lambda batch, batch_id: sinks.sink_rows(job.fold(batch), job.table)  # P16, P18


class Running:
    """Queries that run side by side; each is started again on its own when it fails."""

    def __init__(self, starters: dict[str, Callable[[], StreamingQuery]], attempts: int = 3, delay_s: float = 5.0):
        self.queries: dict[str, StreamingQuery] = {}
        self.errors: dict[str, BaseException] = {}
        self._stopping = threading.Event()
        self._started = {name: threading.Event() for name in starters}
        self._threads = [
            threading.Thread(target=self._keep, args=(name, start, attempts, delay_s), name=f"job-{name}", daemon=True)
            for name, start in starters.items()
        ]
        for t in self._threads:
            t.start()
        for event in self._started.values():
            event.wait()

    def _keep(self, name: str, start: Callable[[], StreamingQuery], attempts: int, delay_s: float) -> None:
        def noted() -> StreamingQuery:
            query = self.queries[name] = start()
            self._started[name].set()
            return query

        try:
            run_with_restarts(noted, attempts, delay_s, self._stopping)
        except Exception as e:  # noqa: BLE001 - kept for wait(); the other jobs go on
            self.errors[name] = e
        finally:
            self._started[name].set()

    def wait(self) -> dict[str, BaseException]:
        """Until all queries have ended; the errors of those that failed for good, by name."""
        for t in self._threads:
            t.join()
        return self.errors

    def stop(self) -> None:
        self._stopping.set()
        for q in list(self.queries.values()):
            q.stop()
        self.wait()


def start_dashboards(
    messages: DataFrame,
    writers: Callable[[str], sinks.BatchWriter],
    settings: JobSettings = JobSettings(),
    rejects: Callable[[str], sinks.BatchWriter] | None = None,
    checkpoint_root: str | None = None,
    only: Sequence[str] | None = None,
    attempts: int = 3,
    delay_s: float = 5.0,
    gate: str | None = None,
) -> Running:
    """Start J1-J4 (or ``only`` some) in one session, and optionally each job's reject feed.

    With a folder ``gate`` (event time), one more query parses the topic for all of them and feeds that
    folder (``streaming.gate``): the jobs read their events there, and rejects and late events of all jobs lie there too.

    ``writers(table)`` gives the batch writer for a result table, e.g.
    ``lambda t: sinks.fan_out(sinks.console(), sinks.JdbcTable(url, t))``; it
    receives rows already shaped for the table, from a persisted batch. ``rejects(job)``
    does so for the messages that the job cannot use.
    """
    starters: dict[str, Callable[[], StreamingQuery]] = {}
    if gate is not None:
        from clickpulse.streaming import gate as gates

        spark = messages.sparkSession
        if rejects is not None:
            raise ValueError("the gate writes the rejects of all jobs to its own folder")
        names = [name for name in JOBS if not only or name in only]
        checkpoint = job_checkpoint(spark, "gate", checkpoint_root)
        starters["gate"] = lambda: gates.start_gate(messages, gate, settings, checkpoint, names)

    def starter(df: DataFrame, name: str, writer: sinks.BatchWriter) -> Callable[[], StreamingQuery]:
        return lambda: start_job(df, name, writer, settings, job_checkpoint(df.sparkSession, name, checkpoint_root))

    for name, job in JOBS.items():
        if only and name not in only:
            continue
        writer = sinks.fan_out(writers(job.table), shape=_shaper(name))
        query = f"{name}_clock" if settings.time == "clock" else name
        if gate is not None:
            metric = job_metric(gates.gated_events(spark, gate, name, settings), name, settings)
        else:
            metric = job.build(messages, settings)
        starters[query] = starter(metric, query, writer)
        if rejects is not None:
            bad = job_rejects(messages, name, settings)
            starters[f"{query}_rejects"] = starter(bad, f"{query}_rejects", rejects(name))
    return Running(starters, attempts, delay_s)


def start_running_totals(
    messages: DataFrame,
    writer: sinks.BatchWriter,
    settings: JobSettings = JobSettings(),
    table: str | None = None,
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """A6 live: J1's closed windows as totals since the start, kept under ``table`` and written as they close."""
    from clickpulse.streaming.running import RunningTotals

    spark, name = messages.sparkSession, "member_running_total"
    windows = member_job(messages, settings)
    table = table or job_checkpoint(spark, f"{name}_rows")
    totals = RunningTotals(spark, table, windows.schema, settings.member_width, writer=writer)
    return start_job(windows, name, totals, settings, checkpoint, available_now=available_now)


def bounded_metric(events: DataFrame, name: str, s: JobSettings):
    """``(stream of sums, its keys, the fold of the finished table)`` of a job over bounded input."""
    if name == "member_total":
        return member_total(events, width=s.member_width), ["window_start"], _as_is
    if name == "item_total":
        return item_counts(events, width=s.item_width), ["item_id", "action", "cat_id", "brand_id", "window_start"], item_rows
    if name == "cat_window":
        panes = cat_panes(events, slide=s.cat_slide)
        return panes, ["cat_id", "window_start"], lambda t: cat_rows(t, s.cat_size, s.cat_slide)
    return province_window(events, width=s.province_width), ["province", "window_start"], _as_is


def run_once(
    messages: DataFrame,
    writers: Callable[[str], sinks.BatchWriter],
    settings: JobSettings = JobSettings(),
    checkpoint_root: str | None = None,
    only: Sequence[str] | None = None,
    attempts: int = 3,
    delay_s: float = 5.0,
) -> None:
    """Process the input available now and write every window of it, open ones included.

    Runs in update mode without a watermark, so nothing is late; the finished table is then written
    as batch 0 of its query. A later run with the same checkpoints takes in new input only
    and replaces that batch by the table as it then is.
    """
    from clickpulse.streaming.replay import read_update_log, start_update_log

    spark = messages.sparkSession
    for name, job in JOBS.items():
        if only and name not in only:
            continue
        sums, keys, fold = bounded_metric(timed_events(messages, name, settings, bounded=True), name, settings)
        checkpoint = job_checkpoint(spark, f"{name}_once", checkpoint_root)
        out = job_checkpoint(spark, f"{name}_once_rows", checkpoint_root)
        q = run_with_restarts(lambda: start_update_log(sums, name, out, checkpoint, keys), attempts, delay_s)  # noqa: B023
        rows = sinks.sink_rows(fold(read_update_log(spark, out, sums, keys)), job.table)
        with sinks.writing_as(str(q.id)):
            sinks.fan_out(writers(job.table))(rows, 0)


def run_with_restarts(
    start: Callable[[], StreamingQuery],
    attempts: int = 3,
    delay_s: float = 5.0,
    stopping: threading.Event | None = None,
) -> StreamingQuery:
    """Run a query to its end; on failure start it again from its checkpoint.

    At most ``attempts`` restarts, ``delay_s`` apart, none once ``stopping`` is set. Within a
    micro-batch, lost executors and failed tasks are retried by Spark itself.
    """
    stopping = stopping or threading.Event()
    for attempt in range(attempts + 1):
        try:
            q = start()
            q.awaitTermination()
        except Exception:
            if attempt == attempts or stopping.wait(delay_s):
                raise
            continue
        return q
    raise AssertionError("unreachable")


def feed_job(spark: SparkSession, csv_path: str, header: bool = False, streaming: bool = False) -> DataFrame:
    """The CSV user log as JSON messages (``value``) ready for a topic.

    Write it with ``sources.kafka.write_messages`` or any text sink. ``streaming`` takes in the log's files as
    they come.
    """
    return to_messages(read_user_log(spark, csv_path, header=header, streaming=streaming))


def start_feed(
    spark: SparkSession,
    csv_path: str,
    out: str,
    checkpoint: str,
    header: bool = False,
    settings: JobSettings = JobSettings(),
    available_now: bool = False,
) -> StreamingQuery:
    """J5 as a stream: every line of the log's files as one message line under ``out``, exactly once.

    Spark's file sink: a batch's files count once they are in its commit log, which Spark's readers
    honour, so a feed that is stopped anywhere and started again repeats and loses nothing. Writing to a
    topic (``sources.kafka.write_messages``) is at least once.
    """
    messages = feed_job(spark, csv_path, header, streaming=True)
    w = messages.writeStream.format("text").queryName("feed").outputMode("append")
    w = w.option("path", out).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=settings.trigger)
    return w.start()
