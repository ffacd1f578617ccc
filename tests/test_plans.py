"""Plan properties the scale design depends on, checked on every registered batch query."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from clickpulse.plans.catalog import BATCH_QUERIES
from conftest import SF001

# Hash-partitioned shuffles each query may have (see README, plan review).
MAX_SHUFFLES = {
    "member_total": 1,
    "province_window": 1,
    "member_grand_total": 1,
    "item_grand_total": 2,
    # The metric of the job, and single-row totals that meet in one place.
    "member_job_balance": 1,
    "item_job_balance": 2,
    "cat_job_balance": 2,
    "province_job_balance": 1,
    "item_total": 2,
    "cat_window": 2,
    # A1's shuffle and the bucket shuffle appear in both join branches of the
    # static plan; at run time the second copy is a ReusedExchange (test below).
    "member_running_total": 5,
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(BATCH_QUERIES))
def test_plan_properties(spark, key):
    plan = plan_text(BATCH_QUERIES[key](spark, SF001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "SortMergeJoin Inner (", "collect"):
        if bad == "SortMergeJoin Inner (" and key == "member_running_total":
            continue  # the join with per-bucket offsets; AQE broadcasts it at run time
        assert bad not in plan, f"{key}: {bad}"
    for schema in re.findall(r"ReadSchema: (struct<[^\n]*>)", plan):
        if "event_type" in schema:
            assert "value:" not in schema, f"{key} reads unused event column: {schema}"
    shuffles = len(re.findall(r"Arguments: hashpartitioning", plan))
    assert shuffles <= MAX_SHUFFLES.get(key, 0), f"{key}: {shuffles} shuffles"


def test_running_total_reuses_its_input_at_run_time(spark):
    df = BATCH_QUERIES["member_running_total"](spark, SF001)
    df.collect()
    text = plan_text(df)
    final_tree = text.split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in text and "ReusedExchange" in final_tree


@pytest.mark.parametrize("job", ["member_total", "item_total", "cat_window", "province_window"])
def test_jobs_read_only_their_fields(spark, job):
    from clickpulse.plans import jobs
    from clickpulse.schema import EVENT_FIELDS
    from clickpulse.sources.testdata import raw_messages

    wire = dict((c, w) for w, c in EVENT_FIELDS)
    messages = spark.createDataFrame([("x",)], "value string")
    plan = jobs.JOBS[job].build(messages, jobs.JobSettings())._jdf.queryExecution().optimizedPlan().toString()
    fields = set(re.findall(r"StructField\((\w+),", plan.split("from_json(")[1].split("(mode")[0]))
    assert fields == {wire[c] for c in jobs.JOB_FIELDS[job]} | {"_corrupt_message"}
    assert raw_messages(spark, SF001).columns == ["event_id", "value"]


def test_no_query_deals_rows_round_robin(spark):
    for key in ("member_total", "item_total", "parse_events"):
        assert "RoundRobin" not in plan_text(BATCH_QUERIES[key](spark, SF001))


def test_click_filter_reaches_the_scan(spark):
    for key in ("click_filter",):
        assert "EqualTo(event_type,click)" in plan_text(BATCH_QUERIES[key](spark, SF001))
