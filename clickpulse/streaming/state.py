"""What a stopped query still holds, read from its checkpoint.

Windows that have not closed are in the state store of the query's aggregation. Spark's ``statestore`` source
reads it like a table, as of the last committed batch: to see what a job would still write, to
check a checkpoint before a restart, or to move its sums elsewhere. The query need not run, and must not
while it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.functions.timeutil import to_wall_clock
from clickpulse.operators.windows import item_rows


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query: ``operatorId, operatorName, stateStoreName, numPartitions`` and batches."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """Keys and values of an operator's state, as ``key`` and ``value`` structs, as of a batch (the last)."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key", "value")


def open_windows(
    spark: SparkSession, checkpoint: str, keys: Sequence[str], sums: Sequence[str], operator: int = 0
) -> DataFrame:
    """The windows that a stopped windowed aggregation still holds: ``keys``, ``sums``, and the window's bounds.

    ``keys`` names the grouping columns besides the window and ``sums`` the aggregated ones, both in the order of the
    query. State keys are read by place, as Spark names them after expressions.
    """
    rows = state_rows(spark, checkpoint, operator)
    key, value = rows.schema["key"].dataType, rows.schema["value"].dataType
    window = next(f.name for f in key.fields if f.name.startswith("window") or f.name == "w")
    plain = [f.name for f in key.fields if f.name != window]
    if len(plain) != len(keys) or len(value.fields) < len(sums):
        raise ValueError(f"the state has keys {key.names} and values {value.names}")
    start = key[window].dataType["start"].dataType
    bounds = [to_wall_clock(F.col(f"key.`{window}`.{b}"), start).alias(f"window_{b}") for b in ("start", "end")]
    return rows.select(
        *[F.col(f"key.`{have}`").alias(name) for have, name in zip(plain, keys, strict=True)],
        *[F.col(f"value.`{f.name}`").alias(name) for f, name in zip(value.fields, sums, strict=False)],
        *bounds,
    )


def open_items(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The rows that a stopped item job (J2) would write if its open windows closed now."""
    return item_rows(open_windows(spark, checkpoint, ["item_id", "action", "cat_id", "brand_id"], ["n"]))
