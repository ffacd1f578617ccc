"""The user-behaviour view ``ub`` over the driver's parquet tables.

``events`` has no action code, category, brand or province; this view assigns
them by fixed rules (see FIXTURES.md section 2) so every metric has realistic
input. ``raw_messages`` turns the view back into JSON messages with a known
share of bad ones, standing in for the broker topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.functions.events import to_messages
from clickpulse.functions.timeutil import ntz_micros, to_instant
from clickpulse.operators.joins import lookup_join

# Fixed values (fixture rule): province by user_id % 36, in index order. The
# municipalities carry the city suffix; the last two have no region code.
FIXTURE_PROVINCES: list[str] = [
    "北京市", "天津市", "河北", "山西", "内蒙古", "辽宁", "吉林", "黑龙江", "上海市",
    "江苏", "浙江", "安徽", "福建", "江西", "山东", "河南", "湖北", "湖南", "广东",
    "广西", "海南", "重庆市", "四川", "贵州", "云南", "西藏", "陕西", "甘肃", "青海",
    "宁夏", "新疆", "台湾", "香港", "澳门", "海外", "广东省",
]
# Fixed values (fixture rule): event_type -> action code; anything else is "9".
FIXTURE_ACTIONS: list[tuple[str, str]] = [("click", "0"), ("signup", "1"), ("purchase", "2"), ("view", "3")]
UNKNOWN_ACTION = "9"
# Fixed values (fixture rule): which messages are damaged, by event_id % 97.
BAD_MESSAGE_MODULUS = 97
NOT_JSON, NO_ACTION_KEY, EMPTY_ACTION, NO_PROVINCE_KEY, NO_CATEGORY_KEY, TEXT_TIME = range(6)

UB_COLUMNS = [
    "event_id", "user_id", "item_id", "cat_id", "merchant_id", "brand_id", "action",
    "age_range", "gender", "province", "event_ms", "ts", "event_time",
]


# Fixed schemas of the tables the view reads (as the driver writes them); given
# to the reader so no file footer is read to infer them.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_behavior(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """The ``ub`` view: one row per event with the reference's ten fields.

    ``events`` may be a streaming DataFrame (file replay); ``part`` is always
    the static table. Extra columns: ``event_id``, ``ts`` (TIMESTAMP_NTZ as
    stored) and ``event_time`` (the same instant as TIMESTAMP, for watermarks).
    """
    if events is None:
        events = read_table(spark, sf_dir, "events")
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_key"), F.col("p_type").alias("cat_id"), F.col("p_brand").alias("brand_id")
    )
    # json_tuple is a generator: the field is extracted once per row. A plain
    # get_json_object would be re-evaluated by every expression and pushed-down
    # filter that uses it.
    e = events.select("event_id", "ts", "user_id", "event_type", F.json_tuple("props", "k").alias("item_id"))
    e = e.withColumn("part_key", F.col("item_id").try_cast("bigint"))
    e = lookup_join(e, part, "part_key")

    idx = F.col("user_id") % len(FIXTURE_PROVINCES)
    province = F.when(idx >= 0, F.try_element_at(F.array(*map(F.lit, FIXTURE_PROVINCES)), (idx + 1).cast("int")))
    action = F.lit(UNKNOWN_ACTION)
    for name, code in reversed(FIXTURE_ACTIONS):
        action = F.when(F.col("event_type") == name, F.lit(code)).otherwise(action)
    ts_type = events.schema["ts"].dataType
    if isinstance(ts_type, T.TimestampNTZType):
        # Floor division in integers: subtract the remainder, then divide exactly.
        us = ntz_micros(F.col("ts"))
        event_ms = ((us - F.pmod(us, F.lit(1000))) / 1000).cast("bigint")
    else:
        event_ms = F.unix_millis(F.col("ts"))
    return e.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        "item_id",
        "cat_id",
        (F.col("part_key") % 10).cast("string").alias("merchant_id"),
        "brand_id",
        action.alias("action"),
        (F.col("user_id") % 9).cast("string").alias("age_range"),
        (F.col("user_id") % 3).cast("string").alias("gender"),
        province.alias("province"),
        event_ms.alias("event_ms"),
        "ts",
        to_instant(F.col("ts"), ts_type).alias("event_time"),
    ).filter(F.col("province").isNotNull())


def raw_messages(spark: SparkSession, sf_dir: str, ub: DataFrame | None = None) -> DataFrame:
    """``(event_id, value)``: the view as JSON messages, some damaged on purpose.

    ``event_id % 97`` of 0 gives ``not json``, 1 drops ``action``, 2 sets it to ``""``, 3 drops
    ``province``, 4 drops ``catId``, 5 makes ``timestamp`` the text ``soon``.
    ``event_id`` stands in for the broker offset.
    """
    if ub is None:
        ub = user_behavior(spark, sf_dir)
    m = F.col("event_id") % BAD_MESSAGE_MODULUS
    none = F.lit(None).cast("string")
    damaged = ub.withColumns(
        {
            "action": F.when(m == NO_ACTION_KEY, none).when(m == EMPTY_ACTION, F.lit("")).otherwise(F.col("action")),
            "province": F.when(m == NO_PROVINCE_KEY, none).otherwise(F.col("province")),
            "cat_id": F.when(m == NO_CATEGORY_KEY, none).otherwise(F.col("cat_id")),
            "event_ms": F.when(m == TEXT_TIME, none).otherwise(F.col("event_ms").cast("string")),
        }
    )
    # The time travels as a JSON number; one that is dropped is put back as text.
    msgs = to_messages(damaged.withColumn("event_ms", F.col("event_ms").cast("bigint")), "event_id")
    soon = F.concat(F.regexp_replace("value", r"\}$", ""), F.lit(',"timestamp":"soon"}'))
    value = F.when(m == NOT_JSON, F.lit("not json")).when(m == TEXT_TIME, soon).otherwise(F.col("value"))
    return msgs.withColumn("value", value)
