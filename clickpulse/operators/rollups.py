"""Totals since the campaign began, running and final.

The dashboards' stated purpose; built on the same counters as A1/A2.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.events import action_flags
from clickpulse.functions.timeutil import duration_us, ntz_micros
from clickpulse.operators.windows import member_total

MEMBER_COUNTS = ["click_count", "addcart_count", "buy_count", "focus_count"]

# Windows per bucket of the running sum; one bucket is sorted within one task.
BUCKET_ROWS = 4096


def running_sum(df: DataFrame, order_by: str, values: Sequence[str], bucket: Column) -> DataFrame:
    """Cumulative sums of ``values`` in ``order_by`` order, computed in parallel.

    ``bucket`` must grow with ``order_by`` (contiguous ranges). Rows are
    shuffled once, by bucket; each bucket's running sums and its total come
    from that one partitioning. Only the per-bucket totals (one row per
    bucket) meet in one task, to become offsets. No task sees all rows.
    """
    # Non-null key: the join below then infers no filter to push into the input.
    b = df.withColumn("_bucket", F.coalesce(bucket.cast("bigint"), F.lit(0).cast("bigint")))
    whole = Window.partitionBy("_bucket")
    inside = whole.orderBy(order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    staged = b.select(
        "*",
        *[F.sum(v).over(inside).alias(f"_run_{v}") for v in values],
        *[F.sum(v).over(whole).alias(f"_tot_{v}") for v in values],
    )
    totals = staged.groupBy("_bucket").agg(*[F.max(f"_tot_{v}").alias(f"_tot_{v}") for v in values])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bucket", *[F.coalesce(F.sum(f"_tot_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in values]
    )
    keep = [c for c in df.columns if c not in values]
    return staged.join(offsets, "_bucket").select(
        *keep, *[(F.col(f"_run_{v}") + F.col(f"_off_{v}")).cast("bigint").alias(v) for v in values]
    )


def member_running_total(events: DataFrame, time_col: str = "event_time", width="3 seconds") -> DataFrame:
    """A6, running: after each A1 window, the site totals since the first event (batch)."""
    windows = member_total(events, time_col, width)
    return running_sum(windows, "window_start", MEMBER_COUNTS, window_bucket(width))


def window_bucket(width, column: str = "window_start") -> Column:
    """Bucket of a window: ``BUCKET_ROWS`` neighbouring ones share one."""
    return F.floor(ntz_micros(F.col(column)) / (duration_us(width) * BUCKET_ROWS))


def member_grand_total(events: DataFrame) -> DataFrame:
    """A6, final: site totals of each action; straight from the counters, so it also streams."""
    f = action_flags(events)
    return f.agg(
        F.sum("click").alias("click_count"),
        F.sum("addcart").alias("addcart_count"),
        F.sum("buy").alias("buy_count"),
        F.sum("focus").alias("focus_count"),
    )


def item_grand_counts(events: DataFrame) -> DataFrame:
    """A7, first step: totals per (item, category, brand): a hash aggregate, and the state of the stream."""
    f = action_flags(events)
    return f.groupBy("item_id", "cat_id", "brand_id").agg(
        F.sum("click").alias("click"), F.sum("buy").alias("buy"), F.sum("focus").alias("focus")
    )


def item_grand_rows(counts: DataFrame) -> DataFrame:
    """A7, second step: one row per item; ``max`` over the ids sees one row per distinct combination."""
    return counts.groupBy("item_id").agg(
        F.max("cat_id").alias("cat_id"),
        F.max("brand_id").alias("brand_id"),
        F.sum("click").alias("item_click_count"),
        F.sum("buy").alias("item_sale_count"),
        F.sum("focus").alias("item_focus_count"),
    )


def item_grand_total(events: DataFrame) -> DataFrame:
    """A7 (batch): one row per item, totals since the start (folds A2's per-action rows)."""
    return item_grand_rows(item_grand_counts(events))
