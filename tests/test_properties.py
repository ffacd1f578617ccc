"""Randomised checks against plain-Python brute force (hypothesis)."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickpulse.functions.regions import CODE_COLUMN, REGION_CODES, with_region
from clickpulse.operators.windows import cat_window, member_total

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
CODES = dict(REGION_CODES)


@SETTINGS
@given(st.lists(st.text(alphabet="市北京上海广东省重庆 ", max_size=5), min_size=1, max_size=40))
def test_province_rule(spark, names):
    df = with_region(spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, province string"))
    got = {r.i: (r.province, r[CODE_COLUMN]) for r in df.collect()}
    for i, n in enumerate(names):
        p = n.replace("市", "") if n.endswith("市") else n
        assert got[i] == (p, CODES.get(p, ""))


T0 = dt.datetime(2024, 1, 1)
events = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["0", "1", "2", "3", "7"]), st.integers(0, 4 * 3600)),
    min_size=1,
    max_size=60,
)


def frame(spark, rows):
    data = [(cat, act, T0 + dt.timedelta(seconds=s)) for cat, act, s in rows]
    return spark.createDataFrame(data, "cat_id string, action string, ts timestamp_ntz").withColumn(
        "event_time", F.col("ts")
    )


@SETTINGS
@given(events, st.sampled_from([(600, 60), (900, 300), (120, 120)]))
def test_panes_equal_builtin_sliding(spark, rows, size_slide):
    size, slide = size_slide
    df = frame(spark, rows)
    a = cat_window(df, "ts", f"{size} seconds", f"{slide} seconds", panes=True)
    b = cat_window(df, "ts", f"{size} seconds", f"{slide} seconds", panes=False)
    assert sorted(a.collect()) == sorted(b.collect())
    clicks = sum(1 for _, act, _ in rows if act == "0")
    assert sum(r.cat_click_count for r in a.collect()) == clicks * (size // slide)


@SETTINGS
@given(events)
def test_member_total_brute_force(spark, rows):
    width = 1800
    want: dict[dt.datetime, Counter] = {}
    for _, act, s in rows:
        start = T0 + dt.timedelta(seconds=s - s % width)
        want.setdefault(start, Counter())[act] += 1
    got = member_total(frame(spark, rows), "ts", f"{width} seconds").collect()
    assert {r.window_start for r in got} == set(want)
    for r in got:
        c = want[r.window_start]
        assert (r.click_count, r.addcart_count, r.buy_count, r.focus_count) == (c["0"], c["1"], c["2"], c["3"])
        assert r.window_end - r.window_start == dt.timedelta(seconds=width)


@SETTINGS
@given(
    st.lists(
        st.tuples(*[st.one_of(st.none(), st.text(max_size=8)) for _ in range(9)], st.integers(0, 2**62)),
        min_size=1,
        max_size=20,
    )
)
def test_json_round_trip_any_text(spark, rows):
    from clickpulse.functions.events import parse_with_status, to_messages
    from clickpulse.schema import EVENT_COLUMNS

    schema = ", ".join(f"{c} {'bigint' if c == 'event_ms' else 'string'}" for c in EVENT_COLUMNS)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    back = parse_with_status(to_messages(df, "i"), "i").orderBy("i").collect()
    assert [tuple(r[c] for c in EVENT_COLUMNS) for r in back] == [tuple(r) for r in rows]
    assert all(r.reject_reason != "malformed" for r in back)
