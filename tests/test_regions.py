"""Province normalisation and region codes."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from clickpulse.functions.regions import CODE_COLUMN, REGION_CODES, region_codes, with_region


def test_lookup_table_shape(spark):
    assert len(REGION_CODES) == 34
    names = [p for p, _ in REGION_CODES]
    codes = [c for _, c in REGION_CODES]
    assert len(set(names)) == 34 and len(set(codes)) == 34
    assert all(re.fullmatch(r"CN-\d\d", c) for c in codes)
    assert region_codes(spark).count() == 34


@pytest.mark.parametrize(
    "name,province,code",
    [
        ("上海市", "上海", "CN-31"),
        ("市北市", "北", ""),
        ("广东省", "广东省", ""),
        ("广东", "广东", "CN-44"),
        ("海外", "海外", ""),
        ("重庆市", "重庆", "CN-50"),
    ],
)
def test_normalize_and_code(spark, name, province, code):
    r = with_region(spark.createDataFrame([(name,)], "province string")).collect()[0]
    assert (r.province, r[CODE_COLUMN]) == (province, code)


def test_lookup_is_a_projection_not_a_join(spark):
    df = with_region(spark.range(10).select(F.lit("北京市").alias("province")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_map_lookup_equals_broadcast_join(spark):
    # The literal-map lookup gives what SURVEY's broadcast left join gives.
    from clickpulse.functions.regions import normalize_province
    from clickpulse.sources.testdata import user_behavior
    from conftest import SF01

    ub = user_behavior(spark, SF01).select("event_id", normalize_province("province").alias("province"))
    via_map = with_region(ub)
    via_join = ub.join(F.broadcast(region_codes(spark)), "province", "left").select(
        "event_id", "province", F.coalesce(F.col(CODE_COLUMN), F.lit("")).alias(CODE_COLUMN)
    )
    a = via_map.select("event_id", "province", CODE_COLUMN)
    assert a.exceptAll(via_join).count() == 0 and via_join.exceptAll(a).count() == 0
