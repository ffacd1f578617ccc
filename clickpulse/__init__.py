"""clickpulse: live e-commerce behaviour metrics on Spark.

Each metric is one DataFrame -> DataFrame function that works the same on a
batch DataFrame and on a Structured Streaming one; sources, sinks and the four
dashboard jobs are built around them.
"""

from clickpulse.functions.events import action_flags, clicks, parse_events, reject_events, to_messages
from clickpulse.functions.regions import normalize_province, region_code, with_region
from clickpulse.operators.rollups import item_grand_total, member_grand_total, member_running_total
from clickpulse.operators.windows import cat_window, item_total, member_total, province_window
from clickpulse.session import get_session, storage_root

__all__ = [
    "action_flags",
    "cat_window",
    "clicks",
    "get_session",
    "item_grand_total",
    "item_total",
    "member_grand_total",
    "member_running_total",
    "member_total",
    "normalize_province",
    "parse_events",
    "province_window",
    "region_code",
    "reject_events",
    "storage_root",
    "to_messages",
    "with_region",
]
