"""Replay the event table as a stream and run the metric functions on it.

The replay reads parquet files as they appear (``maxFilesPerTrigger`` files per
micro-batch); ``run_to_table`` drives a query to the end of its input and
returns the final result as a batch DataFrame.

A replay loses nothing, in whatever order its files come: the query runs in update
mode without a watermark, so every window stays open. Its state is one row per group (use the
RocksDB state store, which ``get_session`` sets, so that it need not fit in memory). Each
micro-batch writes the groups it changed to an update log (``streaming.update_log``), which a batch
that runs again cannot double and which is merged as it grows. The final table is the newest row
per group, a partial-then-final aggregate. Nothing passes through the driver.

Streams hold plain sums only. What has to be folded (``max`` over ids, panes into
sliding windows) is folded when the table is read back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpulse.operators.rollups import item_grand_counts, item_grand_rows, member_grand_total
from clickpulse.operators.windows import cat_panes, cat_rows, item_counts, item_rows, member_total, province_window
from clickpulse.plans.catalog import CAT_SIZE, CAT_SLIDE, ITEM_WIDTH, MEMBER_WIDTH, PROVINCE_WIDTH
from clickpulse.session import scratch_path
from clickpulse.sources.testdata import TABLE_SCHEMAS, read_table, user_behavior
from clickpulse.streaming.running import RunningTotals
from clickpulse.streaming.update_log import UpdateLog, latest_per_key

#: Micro-batches of the registered replays.
REPLAY_BATCHES = 3
#: How late an event may come at the registered gate.
GATE_LATENESS = "10 days"


def replay_events(
    spark: SparkSession, source_dir: str, pattern: str = "events*.parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """A streaming DataFrame over the parquet files matching ``pattern`` in ``source_dir``.

    The schema is the event table's fixed schema, never inferred.
    """
    schema = TABLE_SCHEMAS["events"]
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(f"{source_dir.rstrip('/')}/{pattern}")


def stream_view(
    spark: SparkSession, sf_dir: str, events: DataFrame | None = None, watermark: str | None = None
) -> DataFrame:
    """The ``ub`` view over a replayed event stream.

    With a ``watermark`` on ``event_time``, windows behind it are closed and later events for
    them are dropped; without one (the default) nothing is.
    """
    if events is None:
        events = replay_events(spark, sf_dir)
    view = user_behavior(spark, sf_dir, events=events)
    return view.withWatermark("event_time", watermark) if watermark else view


def shuffled_replay(spark: SparkSession, sf_dir: str, batches: int = REPLAY_BATCHES) -> DataFrame:
    """The event table as a stream of files out of time order, in about ``batches`` micro-batches.

    Events are dealt to files by a hash of their id, so every file spans the whole time.
    """
    path = scratch_path(spark, "replay", "events")
    events = read_table(spark, sf_dir, "events")
    dealt = events.withColumn("_file", F.pmod(F.xxhash64("event_id"), F.lit(batches)))
    dealt.write.partitionBy("_file").parquet(path)
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    return replay_events(spark, path, "_file=*/*.parquet", max(1, -(-files // batches)))


def start_update_log(df: DataFrame, name: str, out: str, checkpoint: str, keys: Sequence[str]) -> StreamingQuery:
    """Start ``df`` in update mode over all input available now, writing changed rows to the log at ``out``."""
    return start_updates(df, name, UpdateLog(df.sparkSession, out, df.schema, keys).write, checkpoint)


def start_updates(
    df: DataFrame, name: str, write: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Start ``df`` in update mode over all input available now; ``write`` gets the changed rows of each batch."""
    return (
        df.writeStream.queryName(f"{name}_{checkpoint.rsplit('-', 1)[-1].rsplit('/', 1)[-1]}")
        .outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_table(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    checkpoint: str | None = None,
    out: str | None = None,
) -> DataFrame:
    """Run streaming ``df`` over all input available now; return its final result.

    ``checkpoint`` and ``out`` default to fresh folders under the shared root;
    passing the same ones again resumes from the checkpoint (restart test).
    """
    spark = df.sparkSession
    out = out or scratch_path(spark, "tables", name)
    start_update_log(df, name, out, checkpoint or scratch_path(spark, "streams", name), keys).awaitTermination()
    return read_update_log(spark, out, df, keys)


def read_update_log(spark: SparkSession, out: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest rows of the log; empty if no batch has written one. Any other read error is raised."""
    return UpdateLog(spark, out, df.schema, keys).read()


def _replay(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    metric: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
) -> DataFrame:
    view = stream_view(spark, sf_dir, shuffled_replay(spark, sf_dir))
    return run_to_table(metric(view), name, keys)


def q_stream_member_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replay(spark, sf_dir, "member_total", lambda e: member_total(e, width=MEMBER_WIDTH), ["window_start"])


def q_stream_item_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["item_id", "action", "cat_id", "brand_id", "window_start"]
    return item_rows(_replay(spark, sf_dir, "item_total", lambda e: item_counts(e, width=ITEM_WIDTH), keys))


def q_stream_cat_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    panes = _replay(spark, sf_dir, "cat_window", lambda e: cat_panes(e, slide=CAT_SLIDE), ["cat_id", "window_start"])
    return cat_rows(panes, CAT_SIZE, CAT_SLIDE)


def q_stream_province_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["province", "window_start"]
    return _replay(spark, sf_dir, "province_window", lambda e: province_window(e, width=PROVINCE_WIDTH), keys)


def q_stream_member_grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 as a stream: site totals since the start, straight from the counters (one state row)."""
    return _replay(spark, sf_dir, "member_grand_total", member_grand_total, [])


def q_stream_item_grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 as a stream: totals since the start, one state row per item, category and brand."""
    keys = ["item_id", "cat_id", "brand_id"]
    return item_grand_rows(_replay(spark, sf_dir, "item_grand_total", item_grand_counts, keys))


def q_stream_member_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6, running, as a stream: totals since the start after each window, kept up batch by batch."""
    view = stream_view(spark, sf_dir, shuffled_replay(spark, sf_dir))
    windows = member_total(view, width=MEMBER_WIDTH)
    totals = RunningTotals(spark, scratch_path(spark, "tables", "member_running"), windows.schema, MEMBER_WIDTH)
    start_updates(windows, "member_running", totals, scratch_path(spark, "streams", "member_running")).awaitTermination()
    return totals.read()


def q_stream_csv_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3, J5 as a stream: the log arrives in files, the feed is stopped in the middle and started again."""
    from clickpulse.functions.events import parse_events
    from clickpulse.plans.catalog import user_log_lines
    from clickpulse.plans.jobs import start_feed
    from clickpulse.schema import EVENT_COLUMNS

    log, out, checkpoint = (scratch_path(spark, "feed", k) for k in ("log", "messages", "checkpoint"))
    lines = user_log_lines(spark, sf_dir).withColumn("_part", F.pmod(F.xxhash64("value"), F.lit(2)))
    for part in range(2):
        lines.where(F.col("_part") == part).select("value").write.mode("append").text(log)
        start_feed(spark, log, out, checkpoint, available_now=True).awaitTermination()
    messages = spark.read.schema("value string").text(out)
    return parse_events(messages).select(*[c for c in EVENT_COLUMNS if c != "event_ms"])


def q_gate_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages, out of order, that each job counts, rejects, or gets too late, with ten days' allowance.

    Messages come in ``REPLAY_BATCHES`` files by event id, one micro-batch each; ``counted`` is what the job
    itself adds up from what the gate passed on.
    """
    from clickpulse.plans import jobs
    from clickpulse.plans.catalog import event_settings
    from clickpulse.sources.testdata import raw_messages
    from clickpulse.streaming import gate

    src, root, checkpoints = (scratch_path(spark, "gate", k) for k in ("messages", "feeds", "checkpoints"))
    settings = event_settings(watermark=GATE_LATENESS)
    messages = raw_messages(spark, sf_dir).withColumn("_part", F.col("event_id") % REPLAY_BATCHES)
    for part in range(REPLAY_BATCHES):
        messages.where(F.col("_part") == part).select("value").write.mode("append").text(src)
        stream = spark.readStream.schema("value string").text(src)
        gate.start_gate(stream, root, settings, f"{checkpoints}/gate", available_now=True).awaitTermination()
    counted = None
    for job in jobs.JOBS:
        events = gate.gated_events(spark, root, job, settings, bounded=True)
        sums, keys, fold = jobs.bounded_metric(events, job, settings)
        table = fold(run_to_table(sums, f"gate_{job}", keys))
        counters = [F.col(c) for c in table.columns if c.endswith("_count")]
        windows = 1
        if job == "cat_window":
            size, slide = gate.job_windows(job, settings)
            windows = size // slide
        total = F.coalesce(F.sum(sum(counters[1:], counters[0])), F.lit(0)) / windows
        row = table.agg(total.cast("bigint").alias("counted")).select(F.lit(job).alias("job"), "counted")
        counted = row if counted is None else counted.unionByName(row)
    return gate.gate_balance(spark, root).join(counted, "job")


STREAM_QUERIES = {
    "stream_csv_feed": q_stream_csv_feed,
    "gate_balance": q_gate_balance,
    "stream_member_running_total": q_stream_member_running_total,
    "stream_member_total": q_stream_member_total,
    "stream_item_total": q_stream_item_total,
    "stream_cat_window": q_stream_cat_window,
    "stream_province_window": q_stream_province_window,
    "stream_member_grand_total": q_stream_member_grand_total,
    "stream_item_grand_total": q_stream_item_grand_total,
}

__all__ = ["STREAM_QUERIES", "latest_per_key", "replay_events", "run_to_table", "stream_view"]
