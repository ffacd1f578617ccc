"""A6 as a stream: totals since the start, kept up by each micro-batch of windows.

The step after the windowed sums. Two update logs (``streaming.update_log``) hold what
the batches have changed: the windows, and one row of totals per bucket of ``BUCKET_ROWS`` neighbouring
windows. A batch rewrites its windows and the totals of the buckets they lie in, from these
buckets alone. The running total of a window is then the totals of the buckets before its own, and the
windows before it in its own bucket: neither reading the newest totals nor adding to them
goes through the windows of the past.

Windows may come in any order and change again (update mode), or once each as they close
(append mode). A batch that runs again writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.operators.rollups import MEMBER_COUNTS, window_bucket
from clickpulse.streaming.update_log import UpdateLog

_BUCKET = "bucket"


class RunningTotals:
    """A ``foreachBatch`` function over windows, and the table of their running totals under ``path``.

    ``writer`` gets, after each batch, the running totals of the batch's windows as they now are. In append
    mode with a watermark windows close in order, so these are final.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        width,
        values: Sequence[str] = MEMBER_COUNTS,
        order: str = "window_start",
        writer: Callable[[DataFrame, int], None] | None = None,
    ):
        self.values, self.order, self.width, self.writer = list(values), order, width, writer
        self.columns = schema.names
        bucket = T.StructField(_BUCKET, T.LongType())
        sums = [T.StructField(v, T.LongType()) for v in self.values]
        self.windows = UpdateLog(spark, f"{path}/windows", T.StructType([*schema.fields, bucket]), [_BUCKET, order])
        self.totals = UpdateLog(spark, f"{path}/totals", T.StructType([bucket, *sums]), [_BUCKET])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(_BUCKET, window_bucket(self.width, self.order))
        rows.persist()
        try:
            self.windows.write(rows, batch_id)
            # The newest windows of a batch lie in a few buckets; a replay's in at most all.
            touched = rows.select(_BUCKET).distinct()
            now = self.windows.read(batch_id).join(touched, _BUCKET, "left_semi")
            self.totals.write(now.groupBy(_BUCKET).agg(*[F.sum(v).alias(v) for v in self.values]), batch_id)
            if self.writer is not None:
                changed = rows.select(self.order)
                running = self._running(now, batch_id).join(changed, self.order, "left_semi")
                self.writer(running.select(*self.columns), batch_id)
        finally:
            rows.unpersist()

    def _running(self, windows: DataFrame, upto: int | None) -> DataFrame:
        before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
        offsets = self.totals.read(upto).select(
            _BUCKET, *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_off_{v}") for v in self.values]
        )
        inside = Window.partitionBy(_BUCKET).orderBy(self.order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        keep = [c for c in windows.columns if c not in self.values]
        summed = windows.select(*keep, *[F.sum(v).over(inside).alias(v) for v in self.values])
        return summed.join(offsets, _BUCKET).select(
            *keep, *[(F.col(v) + F.col(f"_off_{v}")).cast("bigint").alias(v) for v in self.values]
        )

    def read(self, since: int | None = None) -> DataFrame:
        """The running totals of all windows, or of those in buckets from ``since`` on."""
        where = None if since is None else F.col(_BUCKET) >= since
        return self._running(self.windows.read(where=where), None).select(*self.columns)

    def now(self) -> DataFrame:
        """The totals since the start: one row, from the buckets' totals alone; null counts before the first window."""
        return self.totals.read().agg(*[F.sum(v).alias(v) for v in self.values])
