"""One parse of the topic for all jobs: what each counts, what it rejects, what came too late.

The gate is a query of its own before the jobs. It parses each message once, works out for every job whether it
can use the message, and hands over, per micro-batch,

* ``accepted``: the events that some job counts, with the jobs that do;
* ``rejects``: a row per message and job that cannot use it, with the reason;
* ``late``: a row per message and job whose windows for it had all closed;
* ``balance``: per job, how many messages went which way. The three always make up all messages;
* ``offsets``: the next offset of each partition, if the messages carry theirs (``sources.kafka``);
* ``clock``: the latest event time so far, from which the next batch's watermark follows.

An event is late when the last window of the job that holds it ended at or before the watermark: the latest
event time of *earlier* batches less the allowed lateness. The jobs then read ``accepted`` with the same
lateness. A job that has seen no batch but the gate's earlier ones has a watermark no further than the gate's, so it
drops none of them: counted + rejected + late = messages, for each job.

A batch's events appear in one step (a folder renamed when complete), whole or not at all, and a batch that
runs again leaves what is there. The other feeds are overwritten by a batch that runs again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpulse.functions.events import reasons_by_reader
from clickpulse.functions.timeutil import duration_us
from clickpulse.plans.jobs import JOB_FIELDS, JOBS, JobSettings, job_needs
from clickpulse.schema import EVENT_COLUMNS
from clickpulse.session import delete_path, list_folder, publish_folder
from clickpulse.sources.kafka import PLACE, next_offsets

_EVENT_TYPES = ", ".join(f"{c} {'bigint' if c == 'event_ms' else 'string'}" for c in EVENT_COLUMNS)
ACCEPTED_DDL = f"value string, {_EVENT_TYPES}, action_code int, event_time timestamp, jobs array<string>"
BALANCE_DDL = "job string, messages bigint, accepted bigint, rejected bigint, late bigint"
CLOCK_DDL = "latest bigint"


def job_windows(job: str, s: JobSettings) -> tuple[int, int]:
    """``(size, slide)`` of a job's windows in microseconds."""
    size = {
        "member_total": s.member_width,
        "item_total": s.item_width,
        "cat_window": s.cat_size,
        "province_window": s.province_width,
    }[job]
    return duration_us(size), duration_us(s.cat_slide if job == "cat_window" else size)


def routed(messages: DataFrame, s: JobSettings = JobSettings(time="event"), only: Sequence[str] | None = None, *keep: str) -> DataFrame:
    """Every message with its fields, event time, and ``reasons``: per job, why it cannot use it (null if it can)."""
    names = [j for j in JOBS if not only or j in only]
    return reasons_by_reader(messages, {j: job_needs(j, s) for j in names}, *keep).withColumn(
        "event_time", F.timestamp_millis(F.col("event_ms"))
    )


def reject_feed(messages: DataFrame, s: JobSettings = JobSettings(), only: Sequence[str] | None = None, *keep: str) -> DataFrame:
    """The reject feeds of all jobs from one parse: ``keep`` columns, ``value, job, reject_reason``."""
    rows = routed(messages, s, only, *keep)
    bad = F.explode(F.filter("reasons", lambda r: r["reason"].isNotNull())).alias("r")
    return rows.select(*keep, "value", bad).select(*keep, "value", F.col("r.job").alias("job"), F.col("r.reason").alias("reject_reason"))


def _late(job: Column, s: JobSettings, mark: Column) -> Column:
    """Whether the last window of ``job`` that holds the event has closed; nothing is late before anything has been seen."""
    us = F.unix_micros("event_time")
    out = F.lit(False)
    for name in JOBS:
        size, slide = job_windows(name, s)
        closed = us - F.pmod(us, F.lit(slide)) + size <= mark
        out = F.when(job == name, F.coalesce(closed, F.lit(False))).otherwise(out)
    return out


@dataclass(frozen=True)
class Gate:
    """A ``foreachBatch`` function over routed messages; ``root`` holds the feeds."""

    spark: SparkSession
    root: str
    settings: JobSettings

    def _path(self, feed: str) -> str:
        return f"{self.root.rstrip('/')}/{feed}"

    def _batch(self, feed: str, batch_id: int) -> str:
        return f"{self._path(feed)}/batch_id={batch_id}"

    def watermark(self, batch_id: int) -> int | None:
        """The watermark of a batch in epoch microseconds: the latest event time that the batch before it knew, less the lateness."""
        known = [int(n.partition("=")[2]) for n in list_folder(self.spark, self._path("clock")) if n.startswith("batch_id=")]
        before = max((b for b in known if b < batch_id), default=None)
        if before is None:
            return None
        lateness = duration_us(self.settings.watermark or 0)
        row = self.spark.read.schema(CLOCK_DDL).parquet(self._batch("clock", before)).first()
        return None if row is None else row["latest"] - lateness

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        mark = self.watermark(batch_id)
        at = F.lit(mark).cast("bigint")
        places = [c for c in PLACE if c in batch.columns]
        fate = F.transform("reasons", lambda r: F.struct(r["job"], r["reason"], (r["reason"].isNull() & _late(r["job"], self.settings, at)).alias("late")))
        rows = batch.withColumn("fates", fate).drop("reasons").persist()
        try:
            each = rows.select(*places, "value", F.inline("fates"))
            bad, late = F.col("reason").isNotNull(), F.col("late")
            rejects = each.where(bad).select(*places, "value", "job", F.col("reason").alias("reject_reason"))
            self._write(rejects, "rejects", batch_id)
            self._write(each.where(late).select(*places, "value", "job"), "late", batch_id)
            counts = each.groupBy("job").agg(
                F.count(F.lit(1)).alias("messages"),
                F.count_if(~bad & ~late).alias("accepted"),
                F.count_if(bad).alias("rejected"),
                F.count_if(late).alias("late"),
            )
            self._write(counts.coalesce(1), "balance", batch_id)
            if len(places) == len(PLACE):
                self._write(next_offsets(rows).coalesce(1), "offsets", batch_id)
            self._accept(rows, batch_id)
            self._clock(rows, mark, batch_id)
        finally:
            rows.unpersist()

    def _write(self, rows: DataFrame, feed: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(self._batch(feed, batch_id))

    def _accept(self, rows: DataFrame, batch_id: int) -> None:
        counting = F.filter("fates", lambda r: r["reason"].isNull() & ~r["late"])
        events = rows.withColumn("jobs", F.transform(counting, lambda r: r["job"])).where(F.size("jobs") > 0)
        draft = f"{self._path('accepted')}/_batch_id={batch_id}"
        delete_path(self.spark, draft)  # of an attempt that broke off
        events.select("value", *EVENT_COLUMNS, "action_code", "event_time", "jobs").write.parquet(draft)
        publish_folder(self.spark, draft, self._batch("accepted", batch_id))

    def _clock(self, rows: DataFrame, mark: int | None, batch_id: int) -> None:
        """The latest event time up to this batch, of messages that any job can use."""
        usable = F.exists("fates", lambda r: r["reason"].isNull())
        so_far = None if mark is None else mark + duration_us(self.settings.watermark or 0)
        latest = rows.where(usable).agg(F.max(F.unix_micros("event_time")).alias("latest"))
        latest = latest.select(F.greatest("latest", F.lit(so_far).cast("bigint")).alias("latest")).where("latest IS NOT NULL")
        self._write(latest.coalesce(1), "clock", batch_id)


def start_gate(
    messages: DataFrame,
    root: str,
    settings: JobSettings,
    checkpoint: str,
    only: Sequence[str] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Route the messages of a topic to the feeds under ``root``; ``settings`` are those of the jobs behind it."""
    if settings.time != "event" or settings.watermark is None:
        raise ValueError("the gate works in event time and needs a watermark: how late an event may come")
    places = [c for c in PLACE if c in messages.columns]
    w = (
        routed(messages, settings, only, *places)
        .writeStream.queryName("gate")
        .foreachBatch(Gate(messages.sparkSession, root, settings))
        .option("checkpointLocation", checkpoint)
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=settings.trigger)
    return w.start()


def gated_events(spark: SparkSession, root: str, job: str, settings: JobSettings, bounded: bool = False) -> DataFrame:
    """The events that the gate passed on to ``job``, as a stream with the watermark of the settings unless ``bounded``."""
    events = spark.readStream.schema(ACCEPTED_DDL).parquet(f"{root.rstrip('/')}/accepted/batch_id=*/*.parquet")
    events = events.where(F.array_contains("jobs", job))
    events = events.select(*JOB_FIELDS[job], "action_code", "event_time")
    return events if bounded else events.withWatermark("event_time", settings.watermark)


def gate_balance(spark: SparkSession, root: str) -> DataFrame:
    """``job, messages, accepted, rejected, late`` over all batches of the gate."""
    rows = spark.read.schema(BALANCE_DDL).parquet(f"{root.rstrip('/')}/balance")
    return rows.groupBy("job").agg(*[F.sum(c).alias(c) for c in ("messages", "accepted", "rejected", "late")])
