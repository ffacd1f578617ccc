"""Window metrics: edge cases and cross-metric properties."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickpulse.operators.rollups import item_grand_total, member_grand_total, member_running_total
from clickpulse.operators.windows import cat_window, item_total, member_total, province_window
from clickpulse.sources.testdata import user_behavior
from conftest import SF01

COLS = "item_id string, action string, cat_id string, brand_id string, province string, ts timestamp_ntz"


def ev(spark, rows):
    return spark.createDataFrame(rows, COLS).withColumn("event_time", F.col("ts"))


T0 = dt.datetime(2024, 1, 1, 0, 0, 5)


def test_one_click_six_sliding_windows(spark):
    df = ev(spark, [("i", "0", "c", "b", "北京", T0)])
    for panes in (True, False):
        rows = cat_window(df, "ts", "60 seconds", "10 seconds", panes=panes).orderBy("window_start").collect()
        assert [r.cat_click_count for r in rows] == [1] * 6
        assert rows[0].window_start == dt.datetime(2023, 12, 31, 23, 59, 10)
        assert rows[-1].window_end == dt.datetime(2024, 1, 1, 0, 1, 0)


def test_category_max_is_lexicographic(spark):
    df = ev(spark, [("i", "0", "9", "b", "p", T0), ("i", "0", "10", "b", "p", T0)])
    assert item_total(df, "ts", "3 seconds").collect()[0].cat_id == "9"


def test_item_rows_split_by_action(spark):
    df = ev(spark, [("i", a, "c", "b", "p", T0) for a in ("0", "0", "1", "2", "7")])
    rows = {r.action: r for r in item_total(df, "ts", "3 seconds").collect()}
    assert (rows["0"].item_click_count, rows["0"].item_sale_count) == (2, 0)
    assert (rows["1"].item_click_count, rows["1"].item_sale_count, rows["1"].item_focus_count) == (0, 0, 0)
    assert rows["2"].item_sale_count == 1 and rows["7"].item_click_count == 0


def test_unknown_only_window_gives_zero_row(spark):
    df = ev(spark, [("i", "7", "c", "b", "p", T0)])
    r = member_total(df, "ts", "3 seconds").collect()[0]
    assert (r.click_count, r.addcart_count, r.buy_count, r.focus_count) == (0, 0, 0, 0)


def test_missing_keys_are_groups_of_their_own(spark):
    df = ev(spark, [("i", "1", "c", "b", "上海市", T0), ("i", "0", None, "b", None, T0)])
    rows = {r.province: r for r in province_window(df, "ts", "10 seconds").collect()}
    assert (rows["上海"].province_iso_3316_code, rows["上海"].click_count) == ("CN-31", 0)
    assert (rows[None].province_iso_3316_code, rows[None].click_count) == ("", 1)
    for panes in (True, False):
        rows = cat_window(df, "ts", "10 seconds", "10 seconds", panes=panes).collect()
        assert [(r.cat_id, r.cat_click_count) for r in rows] == [(None, 1)]


@pytest.fixture(scope="module")
def ub(spark):
    return user_behavior(spark, SF01).cache()


def test_properties_over_fixture(spark, ub):
    clicks = ub.filter("action = '0'").count()
    m = member_total(ub, width="3 hours").agg(*[F.sum(c).alias(c) for c in ("click_count", "buy_count", "focus_count")])
    m = m.collect()[0]
    assert m.click_count == clicks
    c = cat_window(ub, size="60 hours", slide="10 hours").agg(F.sum("cat_click_count")).collect()[0][0]
    assert c == 6 * clicks
    p = province_window(ub, width="10 hours").agg(*[F.sum(x).alias(x) for x in ("click_count", "buy_count", "focus_count")])
    assert p.collect()[0] == m


def test_pane_form_equals_sliding_window(spark, ub):
    a = cat_window(ub, size="60 hours", slide="10 hours", panes=True)
    b = cat_window(ub, size="60 hours", slide="10 hours", panes=False)
    assert a.count() == 463
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_many_panes_per_window(spark, ub):
    # 360 panes per window: pane offsets exceed INT range in microseconds.
    a = cat_window(ub, size="60 minutes", slide="10 seconds", panes=True)
    b = cat_window(ub, size="60 minutes", slide="10 seconds", panes=False)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sliding_non_multiple_falls_back(spark, ub):
    a = cat_window(ub, size="25 hours", slide="10 hours")
    b = cat_window(ub, size="25 hours", slide="10 hours", panes=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rollups_agree(spark, ub):
    g = member_grand_total(ub).collect()[0]
    last = member_running_total(ub, width="3 hours").orderBy(F.desc("window_start")).first()
    assert tuple(g) == (last.click_count, last.addcart_count, last.buy_count, last.focus_count)
    items = item_total(ub, width="3 hours").groupBy("item_id").agg(F.sum("item_click_count").alias("c"))
    direct = item_grand_total(ub).select("item_id", F.col("item_click_count").alias("c"))
    assert items.exceptAll(direct).count() == 0


def test_running_total_small_buckets(spark, ub, monkeypatch):
    # Force many buckets so offsets between buckets are exercised.
    import clickpulse.operators.rollups as r

    monkeypatch.setattr(r, "BUCKET_ROWS", 7)
    rows = r.member_running_total(ub, width="3 hours").orderBy("window_start").collect()
    base = member_total(ub, width="3 hours").orderBy("window_start").collect()
    acc = 0
    for x, y in zip(rows, base, strict=True):
        acc += y.click_count
        assert x.click_count == acc


def test_windows_do_not_depend_on_session_zone(spark, ub):
    want = member_total(ub, width="3 hours").collect()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = member_total(user_behavior(spark, SF01), width="3 hours").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(want) == sorted(got)


def test_lookup_join_leaves_the_choice_to_spark(spark, scratch):
    from clickpulse.operators.joins import lookup_join

    path = scratch("lookup")
    spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).write.parquet(path)
    big = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id"))
    small = spark.read.parquet(path)
    want = sorted(big.join(small, "k").collect())
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        for threshold, node in (("10m", "BroadcastHashJoin"), ("-1", "SortMergeJoin")):
            spark.conf.set(limit, threshold)
            got = lookup_join(big, small, "k")
            assert node in got._jdf.queryExecution().executedPlan().toString()
            assert sorted(got.collect()) == want
    finally:
        spark.conf.set(limit, before)


def test_per_event_aggregates_do_not_sort(spark, ub):
    from clickpulse.operators.rollups import item_grand_counts
    from clickpulse.operators.windows import cat_panes, item_counts

    for df in (item_counts(ub, width="3 hours"), item_grand_counts(ub), cat_panes(ub, slide="10 hours")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
