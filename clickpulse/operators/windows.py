"""A1-A4: the four dashboard metrics as windowed aggregations.

Every function takes the event DataFrame (batch or streaming), the name of its
time column (event time for replays and tests, arrival time for live parity)
and the window widths. Outputs carry ``window_start`` / ``window_end`` as
TIMESTAMP_NTZ (UTC wall clock); the sink adds its own write time.

Aggregations are partial-then-final (map-side combine), so a hot key, e.g. a
province with a third of all events, costs one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.events import action_flags, with_action_code
from clickpulse.functions.regions import CODE_COLUMN, with_region
from clickpulse.functions.timeutil import col_type, duration_us, interval_text, micros_to_ntz, ntz_micros, to_wall_clock
from clickpulse.schema import CLICK


def _bounds(df: DataFrame, time_col: str, w: str = "w") -> list[Column]:
    t = col_type(df, time_col)
    return [
        to_wall_clock(F.col(f"{w}.start"), t).alias("window_start"),
        to_wall_clock(F.col(f"{w}.end"), t).alias("window_end"),
    ]


# Present in clock mode only (``streaming.live``): 1 for an event, 0 for a tick that just moves the clock.
REAL = "_real"


def _grouped(df: DataFrame, keys: list, sums: dict[str, Column]) -> DataFrame:
    """Sums per group. Groups that hold ticks only are dropped, after the aggregate so that ticks still move the watermark."""
    if REAL not in df.columns:
        return df.groupBy(*keys).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    real = F.col(REAL)
    g = df.groupBy(*keys).agg(*[F.sum(c * real).alias(name) for name, c in sums.items()], F.sum(real).alias(REAL))
    return g.where(F.col(REAL) > 0).drop(REAL)


def member_total(events: DataFrame, time_col: str = "event_time", width="3 seconds") -> DataFrame:
    """A1 (+A5, T1): site-wide counts of each action per tumbling window.

    A window holding only unknown actions gives a row of zeros; an empty window
    gives no row.
    """
    f = action_flags(events)
    counts = {f"{c}_count": F.col(c) for c in ("click", "addcart", "buy", "focus")}
    g = _grouped(f, [F.window(time_col, interval_text(width)).alias("w")], counts)
    return g.select(*_bounds(f, time_col), "click_count", "addcart_count", "buy_count", "focus_count")


def item_counts(events: DataFrame, time_col: str = "event_time", width="3 seconds") -> DataFrame:
    """A2, first step: events per (item, action, category, brand) and tumbling window.

    A plain count is a hash aggregate with a map-side combine. ``max`` over the string ids has
    no fixed-width buffer and would sort its input; ``item_rows`` applies it to these few rows.
    """
    g = _grouped(
        events,
        ["item_id", "action", "cat_id", "brand_id", F.window(time_col, interval_text(width)).alias("w")],
        {"n": F.lit(1)},
    )
    return g.select("item_id", "action", "cat_id", "brand_id", "n", *_bounds(events, time_col))


# The item metric's statement. A row is an item *and* an action, so at
# most one counter is not zero; max() over the string ids is lexicographic.
ITEM_ROWS_SQL = """
SELECT item_id, action, window_start, window_end,
       max(cat_id) AS cat_id, max(brand_id) AS brand_id,
       coalesce(sum(n) FILTER (WHERE action = '0'), 0) AS item_click_count,
       coalesce(sum(n) FILTER (WHERE action = '2'), 0) AS item_sale_count,
       coalesce(sum(n) FILTER (WHERE action = '3'), 0) AS item_focus_count
FROM {counts}
GROUP BY item_id, action, window_start, window_end
"""


def item_rows(counts: DataFrame) -> DataFrame:
    """A2, second step: one row per item, action and window."""
    return counts.sparkSession.sql(ITEM_ROWS_SQL, counts=counts).select(
        "item_id",
        "action",
        "cat_id",
        "brand_id",
        "item_click_count",
        "item_sale_count",
        "item_focus_count",
        "window_start",
        "window_end",
    )


def item_total(events: DataFrame, time_col: str = "event_time", width="3 seconds") -> DataFrame:
    """A2 (batch): per item and action, per tumbling window: ``max`` ids and three counts.

    A stream runs ``item_counts`` and folds what it emits with ``item_rows``.
    """
    return item_rows(item_counts(events, time_col, width))


def _category_clicks(events: DataFrame) -> DataFrame:
    c = with_action_code(events)
    counted = F.col("action_code") == CLICK
    if REAL in c.columns:
        counted = counted | (F.col(REAL) == 0)
    return c.filter(counted)


def cat_panes(events: DataFrame, time_col: str = "event_time", slide="10 seconds") -> DataFrame:
    """A3, first step: clicks per category and slide-wide pane, one row or state entry each."""
    c = _category_clicks(events)
    g = _grouped(c, ["cat_id", F.window(time_col, interval_text(slide)).alias("w")], {"n": F.lit(1)})
    return g.select("cat_id", "n", *_bounds(c, time_col))


def cat_rows(panes: DataFrame, size="60 seconds", slide="10 seconds") -> DataFrame:
    """A3, second step: each pane added into the ``size / slide`` windows that contain it."""
    size_us, slide_us = duration_us(size), duration_us(slide)
    if size_us % slide_us:
        raise ValueError("size must be a multiple of slide")
    back = F.explode(F.sequence(F.lit(0), F.lit(size_us // slide_us - 1))).alias("i")
    spread = panes.select("cat_id", "n", ntz_micros(F.col("window_start")).alias("us"), back)
    start = F.col("us") - F.col("i").cast("bigint") * F.lit(slide_us).cast("bigint")
    g = spread.select("cat_id", "n", start.alias("start_us")).groupBy("cat_id", "start_us")
    return g.agg(F.sum("n").alias("cat_click_count")).select(
        "cat_id",
        "cat_click_count",
        micros_to_ntz(F.col("start_us")).alias("window_start"),
        micros_to_ntz(F.col("start_us") + size_us).alias("window_end"),
    )


def cat_window(
    events: DataFrame,
    time_col: str = "event_time",
    size="60 seconds",
    slide="10 seconds",
    panes: bool | None = None,
) -> DataFrame:
    """A3 (+P6, P7, P9, T3): clicks per category in sliding windows.

    Only clicks are kept before grouping, so a category without clicks in a
    window has no row for it. Clicks without a category are a group of their own; the
    jobs reject them before.

    Plan, when ``size`` is a multiple of ``slide`` (``panes``): clicks are counted per category and
    slide-wide pane, and each pane is then added into its windows. The heavy, per-event step
    does one hash update per event instead of one per window, and what it shuffles, or keeps as
    state, is one row per category and pane. A batch uses ``cat_panes`` and ``cat_rows``; a stream chains two
    windowed aggregations, the second over the panes that the first has closed, so it emits each window once
    (append mode, with a watermark). Any other slide takes Spark's sliding ``window`` over the events.
    """
    if panes is None:
        panes = duration_us(size) % duration_us(slide) == 0
    if panes and not events.isStreaming:
        return cat_rows(cat_panes(events, time_col, slide), size, slide)
    c = _category_clicks(events)
    if panes:
        closed = _grouped(c, ["cat_id", F.window(time_col, interval_text(slide)).alias("pane")], {"n": F.lit(1)})
        w = F.window(F.window_time("pane"), interval_text(size), interval_text(slide)).alias("w")
        g = closed.groupBy("cat_id", w).agg(F.sum("n").alias("cat_click_count"))
    else:
        w = F.window(time_col, interval_text(size), interval_text(slide)).alias("w")
        g = _grouped(c, ["cat_id", w], {"cat_click_count": F.lit(1)})
    return g.select("cat_id", "cat_click_count", *_bounds(c, time_col))


def province_window(events: DataFrame, time_col: str = "event_time", width="10 seconds") -> DataFrame:
    """A4 (+P11, P12, T2): per province, per tumbling window: clicks, follows, buys.

    Add-to-cart events raise no counter but still give the province its row.
    The region code depends only on the name, so grouping on it splits nothing.
    Events without a province are a group of their own; the jobs reject them before.
    """
    f = action_flags(with_region(events))
    g = _grouped(
        f,
        ["province", CODE_COLUMN, F.window(time_col, interval_text(width)).alias("w")],
        {"click_count": F.col("click"), "focus_count": F.col("focus"), "buy_count": F.col("buy")},
    )
    return g.select("province", CODE_COLUMN, "click_count", "focus_count", "buy_count", *_bounds(f, time_col))
