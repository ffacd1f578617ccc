"""Every operator of the inventory as a named batch query over the ``ub`` view.

Window widths are the production ones scaled from seconds to hours, since the
test tables spread their events over a month: 3 h for member and item totals,
60 h sliding by 10 h for categories, 10 h for provinces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.functions.events import (
    ALL_NEEDS,
    action_flags,
    clicks,
    parse_events,
    parse_with_status,
    reject_events,
    to_messages,
)
from clickpulse.functions.regions import CODE_COLUMN, normalize_province, region_code
from clickpulse.operators.rollups import item_grand_total, member_grand_total, member_running_total
from clickpulse.operators.windows import cat_window, item_total, member_total, province_window
from clickpulse.schema import CLICK, EVENT_COLUMNS
from clickpulse.session import scratch_path
from clickpulse.sources.testdata import FIXTURE_ACTIONS, raw_messages, read_table, user_behavior
from clickpulse.sources.userlog import to_user_log_lines

MEMBER_WIDTH = "3 hours"
ITEM_WIDTH = "3 hours"
CAT_SIZE, CAT_SLIDE = "60 hours", "10 hours"
PROVINCE_WIDTH = "10 hours"

Query = Callable[[SparkSession, str], DataFrame]


def q_parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON messages to typed events; damaged ones are left out."""
    return parse_events(raw_messages(spark, sf_dir), "event_id")


def q_reject_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: the messages that a reader with all needs cannot use, and why."""
    return reject_events(raw_messages(spark, sf_dir), "event_id", needs=ALL_NEEDS).select("event_id", "reject_reason")


def event_settings(**more):
    """The jobs in event time with the windows of these queries."""
    from clickpulse.plans.jobs import JobSettings

    widths = dict(member_width=MEMBER_WIDTH, item_width=ITEM_WIDTH, cat_size=CAT_SIZE, cat_slide=CAT_SLIDE, province_width=PROVINCE_WIDTH)
    return JobSettings(time="event", **widths, **more)


def q_job_reject_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects of the four jobs from one parse."""
    from clickpulse.streaming.gate import reject_feed

    return reject_feed(raw_messages(spark, sf_dir), event_settings(), None, "event_id").drop("value")


def _job_balance(job: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A job's messages are either counted in its metric or rejected, in event time."""
        from clickpulse.plans import jobs

        return jobs.job_balance(raw_messages(spark, sf_dir), job, event_settings())

    return q


def q_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 then P1: every event to JSON and back."""
    msgs = to_messages(user_behavior(spark, sf_dir), "event_id")
    return parse_with_status(msgs, "event_id").select("event_id", *EVENT_COLUMNS)


def q_csv_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + J5: the view written as the positional CSV log, read back, sent as JSON, parsed.

    ``event_ms`` is the load time by design, so it is left out of the result.
    """
    from clickpulse.plans.jobs import feed_job

    path = scratch_path(spark, "tables", "user_log")
    user_log_lines(spark, sf_dir).write.text(path)
    return parse_events(feed_job(spark, path)).select(*[c for c in EVENT_COLUMNS if c != "event_ms"])


def user_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as log lines. Every 89th event has no province and every 83rd no category: empty fields stay empty texts."""
    ub = user_behavior(spark, sf_dir)
    for column, modulus in (("province", 89), ("cat_id", 83)):
        ub = ub.withColumn(column, F.when(F.col("event_id") % modulus == 0, F.lit("")).otherwise(F.col(column)))
    return to_user_log_lines(ub)


def q_click_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks only."""
    return clicks(_click_view(spark, sf_dir)).select("event_id", "cat_id")


def _click_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view over the events that can be clicks: a plain predicate, so the scan skips other row groups."""
    events = read_table(spark, sf_dir, "events")
    names = [name for name, code in FIXTURE_ACTIONS if code == str(CLICK)]
    return user_behavior(spark, sf_dir, events=events.where(F.col("event_type").isin(names)))


def q_action_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hot action counters."""
    return action_flags(user_behavior(spark, sf_dir)).select("event_id", "click", "addcart", "buy", "focus")


def q_province_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Province names without the municipality suffix."""
    return user_behavior(spark, sf_dir).select("event_id", normalize_province("province").alias("province"))


def q_province_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region code of the normalised name, "" when unknown."""
    p = normalize_province("province")
    return user_behavior(spark, sf_dir).select("event_id", p.alias("province"), region_code(p).alias(CODE_COLUMN))


def q_member_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return member_total(user_behavior(spark, sf_dir), width=MEMBER_WIDTH)


def q_item_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_total(user_behavior(spark, sf_dir), width=ITEM_WIDTH)


def q_cat_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat_window(_click_view(spark, sf_dir), size=CAT_SIZE, slide=CAT_SLIDE)


def q_province_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return province_window(user_behavior(spark, sf_dir), width=PROVINCE_WIDTH)


def q_member_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return member_running_total(user_behavior(spark, sf_dir), width=MEMBER_WIDTH)


def q_member_grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return member_grand_total(user_behavior(spark, sf_dir))


def q_item_grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_grand_total(user_behavior(spark, sf_dir))


def q_once_item_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item job over a folder of message files, processed once through its sink."""
    from clickpulse.plans import jobs
    from clickpulse.sources import sinks

    src, out, root = (scratch_path(spark, "once", k) for k in ("messages", "rows", "checkpoints"))
    raw_messages(spark, sf_dir).select("value").write.text(src)
    settings = jobs.JobSettings(time="event", item_width=ITEM_WIDTH)
    messages = spark.readStream.schema("value string").option("maxFilesPerTrigger", 2).text(src)
    jobs.run_once(messages, lambda table: sinks.parquet(out), settings, root, only=["item_total"])
    rows = spark.read.parquet(out)
    return rows.select(*[c for c in rows.columns if c not in ("time", "query_id", "batch_id")])


BATCH_QUERIES: dict[str, Query] = {
    "parse_events": q_parse_events,
    "json_round_trip": q_json_round_trip,
    "csv_feed": q_csv_feed,
    "click_filter": q_click_filter,
    "action_flags": q_action_flags,
    "reject_events": q_reject_events,
    "job_reject_feed": q_job_reject_feed,
    "member_job_balance": _job_balance("member_total"),
    "item_job_balance": _job_balance("item_total"),
    "cat_job_balance": _job_balance("cat_window"),
    "province_job_balance": _job_balance("province_window"),
    "once_item_total": q_once_item_total,
    "province_normalize": q_province_normalize,
    "province_code": q_province_code,
    "member_total": q_member_total,
    "item_total": q_item_total,
    "cat_window": q_cat_window,
    "province_window": q_province_window,
    "member_running_total": q_member_running_total,
    "member_grand_total": q_member_grand_total,
    "item_grand_total": q_item_grand_total,
}
