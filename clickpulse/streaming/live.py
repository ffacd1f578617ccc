"""Windows that close by the clock, also while the input is idle.

Spark emits a window when the watermark passes its end, and the watermark moves with
input. ``with_clock`` joins a one-row-per-second ``rate`` stream to the events, so there is always
input: its rows have no keys, add zero to every counter and are marked as ticks. The
operators drop the groups that hold ticks only after aggregating (a filter before
the aggregate would take the ticks from the watermark as well).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.operators.windows import REAL


def with_clock(events: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Streaming ``events`` with arrival time, ticks, and a watermark that follows the clock."""
    arrived = events.withColumn(time_col, F.current_timestamp()).withColumn(REAL, F.lit(1))
    ticks = events.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in arrived.schema.fields if f.name not in (time_col, REAL)]
    ticks = ticks.select(*blank, F.current_timestamp().alias(time_col), F.lit(0).alias(REAL))
    return arrived.unionByName(ticks).withWatermark(time_col, "0 seconds")
