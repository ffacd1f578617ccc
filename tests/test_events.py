"""Parsing, rejects and counters on hand-made messages (FIXTURES section 3)."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clickpulse.functions.events import (
    ALL_NEEDS,
    action_flags,
    parse_events,
    parse_with_status,
    reject_events,
    to_messages,
)
from clickpulse.schema import EVENT_COLUMNS


def msgs(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value string")


def test_string_and_numeric_fields(spark):
    df = msgs(spark, '{"action":"0","catId":1580}', '{"action":2,"catId":"a"}')
    rows = parse_events(df, "id").orderBy("id").collect()
    assert [(r.action_code, r.cat_id) for r in rows] == [(0, "1580"), (2, "a")]


def test_rejects_and_reasons(spark):
    df = msgs(spark, '{"catId":"x"}', '{"action":"","catId":"x"}', "not json", '{"action":"7"}', '{"action":"x"}')
    st = {r.id: r.reject_reason for r in parse_with_status(df, "id").collect()}
    assert st == {0: "no action", 1: "bad action", 2: "malformed", 3: None, 4: "bad action"}
    assert sorted(r.id for r in reject_events(df, "id").collect()) == [0, 1, 2, 4]
    assert [r.id for r in parse_events(df, "id").collect()] == [3]


def test_unknown_action_raises_no_counter(spark):
    df = parse_events(msgs(spark, '{"action":"7"}', '{"action":"1"}'), "id")
    rows = action_flags(df).orderBy("id").collect()
    assert [(r.click, r.addcart, r.buy, r.focus) for r in rows] == [(0, 0, 0, 0), (0, 1, 0, 0)]


@pytest.mark.parametrize("bad", ['{"catId":"x"}', '{"action":"","catId":"x"}', "not json"])
def test_strict_fails(spark, bad):
    df = parse_events(msgs(spark, '{"action":"0"}', bad), "id", strict=True)
    with pytest.raises(PySparkException):
        df.collect()


def test_strict_passes_good_rows(spark):
    assert parse_events(msgs(spark, '{"action":"0"}', '{"action":"3"}'), strict=True).count() == 2


def test_round_trip_keeps_every_field(spark):
    row = ("u1", "i1", "c1", "m1", "b1", "2", "5", "1", "上海市", 1700000000123)
    df = spark.createDataFrame([row], ", ".join(f"{c} {'bigint' if c == 'event_ms' else 'string'}" for c in EVENT_COLUMNS))
    text = to_messages(df).collect()[0].value
    assert '"catId":"c1"' in text and '"timestamp":1700000000123' in text
    back = parse_events(to_messages(df)).collect()[0]
    assert tuple(back[c] for c in EVENT_COLUMNS) == row
    assert back.action_code == 2


def test_null_fields_are_left_out_of_json(spark):
    df = spark.createDataFrame([("u1", None)], "user_id string, item_id string")
    for c in EVENT_COLUMNS[2:]:
        df = df.withColumn(c, df.user_id if c != "event_ms" else F.lit(1).cast("bigint"))
    assert "itemId" not in to_messages(df).collect()[0].value


def test_item_job_keeps_odd_actions_as_groups(spark):
    from clickpulse.plans import jobs

    df = msgs(spark, '{"itemId":"i","action":""}', '{"itemId":"i"}', '{"itemId":"i","action":"0","timestamp":"soon"}', "not json")
    assert sorted(r.id for r in parse_events(df, "id", needs=()).collect()) == [0, 1, 2]
    assert [(r.id, r.reject_reason) for r in jobs.job_rejects(df, "item_total", jobs.JobSettings(), "id").collect()] == [
        (3, "malformed")
    ]
    settings = jobs.JobSettings(time="processing", item_width="3650 days")
    rows = {r.action: r for r in jobs.item_job(df, settings).collect()}
    assert set(rows) == {"", None, "0"}
    assert rows[""].item_click_count == 0 and rows[None].item_click_count == 0 and rows["0"].item_click_count == 1
    with pytest.raises(PySparkException):
        parse_events(df, strict=True, needs=()).collect()


ODD = [
    '{"action":"0","catId":"c","province":"p","timestamp":5}',
    "not json",
    '{"catId":"c","province":"p","timestamp":5}',
    '{"action":"","catId":"c","province":"p","timestamp":5}',
    '{"action":"0","catId":"c","timestamp":5}',
    '{"action":"0","province":"p","timestamp":5}',
    '{"action":"2","province":"p","timestamp":5}',
    '{"action":"0","catId":"c","province":"p","timestamp":"soon"}',
    '{"action":"0","catId":"c","province":"p"}',
    '{"action":"0","catId":"","province":"","timestamp":"7"}',
]


def test_one_reason_for_parse_status_rejects_and_strict(spark):
    df = msgs(spark, *ODD)
    want = {
        (): {1: "malformed"},
        ("action",): {1: "malformed", 2: "no action", 3: "bad action"},
        ("action", "category"): {1: "malformed", 2: "no action", 3: "bad action", 5: "no category"},
        ("action", "province"): {1: "malformed", 2: "no action", 3: "bad action", 4: "no province"},
        ("time",): {1: "malformed", 7: "no time", 8: "no time"},
        ALL_NEEDS: {
            1: "malformed", 2: "no action", 3: "bad action", 4: "no province", 5: "no category", 7: "no time", 8: "no time",
        },
    }
    for needs, reasons in want.items():
        assert {r.id: r.reject_reason for r in reject_events(df, "id", needs=needs).collect()} == reasons
        status = {r.id: r.reject_reason for r in parse_with_status(df, "id", needs=needs).collect()}
        assert status == {i: reasons.get(i) for i in range(len(ODD))}
        kept = {r.id for r in parse_events(df, "id", needs=needs).collect()}
        assert kept == set(range(len(ODD))) - set(reasons)
        for bad in reasons:
            with pytest.raises(PySparkException):
                parse_events(df.where(f"id = {bad}"), "id", needs=needs, strict=True).collect()
    assert parse_events(df.where("id in (0, 6, 9)"), needs=ALL_NEEDS, strict=True).count() == 3


@pytest.mark.parametrize("time", ["processing", "event"])
def test_every_message_is_counted_or_rejected_by_every_job(spark, time):
    from clickpulse.plans import jobs

    df, s = msgs(spark, *ODD), jobs.JobSettings(time=time)
    for job in jobs.JOBS:
        counted = jobs.job_events(df, job, s).count()
        assert counted + jobs.job_rejects(df, job, s).count() == len(ODD)
        strict = jobs.JobSettings(time=time, strict=True)
        with pytest.raises(PySparkException):
            jobs.JOBS[job].build(df, strict).collect()
