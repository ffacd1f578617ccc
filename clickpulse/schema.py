"""Fixed schemas: the event message, the CSV user log, and the result tables.

Nothing is inferred; every reader takes one of these.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Wire name (camelCase, as in the JSON message) and column name, in record order.
EVENT_FIELDS: list[tuple[str, str]] = [
    ("userId", "user_id"),
    ("itemId", "item_id"),
    ("catId", "cat_id"),
    ("merchantId", "merchant_id"),
    ("brandId", "brand_id"),
    ("action", "action"),
    ("ageRange", "age_range"),
    ("gender", "gender"),
    ("province", "province"),
    ("timestamp", "event_ms"),
]
EVENT_COLUMNS: list[str] = [c for _, c in EVENT_FIELDS]

# Positional CSV user log: 11 text columns; month and day are present but unused.
USER_LOG_COLUMNS: list[str] = [
    "user_id",
    "item_id",
    "cat_id",
    "merchant_id",
    "brand_id",
    "month",
    "day",
    "action",
    "age_range",
    "gender",
    "province",
]
USER_LOG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in USER_LOG_COLUMNS])

# Action codes carried in the `action` field (click, add to cart,
# buy, follow); any other value raises no counter.
CLICK, ADDCART, BUY, FOCUS = 0, 1, 2, 3

# Result table columns in sink order. Counts are INT at the sink, BIGINT inside.
MEMBER_TOTAL_COLUMNS = ["click_count", "addcart_count", "buy_count", "focus_count", "time"]
ITEM_TOTAL_COLUMNS = [
    "item_id",
    "category_id",
    "brand_id",
    "item_click_count",
    "item_sale_count",
    "item_focus_count",
    "time",
]
CAT_WINDOW_COLUMNS = ["cat_id", "cat_click_count", "time"]
PROVINCE_WINDOW_COLUMNS = [
    "province",
    "province_iso_3316_code",
    "click_count",
    "focus_count",
    "buy_count",
    "time",
]
