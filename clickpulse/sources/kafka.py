"""Kafka topic as source of JSON messages, and as sink for the feed.

The Kafka connector is a separate package (``spark-sql-kafka-0-10``); it is
not installed here, so only the option builders and the ledger are exercised by tests.

Start offsets come from the query checkpoint on restart. A query without a checkpoint (a new one, or one
whose plan has changed) can go on where another got to: ``OffsetLedger`` keeps, per batch, the next offset
of each partition whose messages have been written, and ``starting_offsets`` turns that into
Spark's start position per partition. Partitions that the ledger does not know start at ``latest`` or where the caller
says. Consumer-group commits in the broker are not used.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.functions.events import to_messages
from clickpulse.session import list_folder

#: Columns that locate a message in its topic.
PLACE = ["partition", "offset"]
#: Spark's numbers for the two ends of a partition.
LATEST, EARLIEST = -1, -2

# Fixed value: the topic the event feed is published to.
DEFAULT_TOPIC = "realtime-data"


def kafka_source_options(
    brokers: str, topic: str = DEFAULT_TOPIC, starting_offsets: str = "latest", **extra: str
) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": starting_offsets}
    opts.update({k if k.startswith("kafka.") or k in _SOURCE_KEYS else f"kafka.{k}": v for k, v in extra.items()})
    return opts


_SOURCE_KEYS = {"maxOffsetsPerTrigger", "minOffsetsPerTrigger", "failOnDataLoss", "includeHeaders", "minPartitions"}


def kafka_sink_options(brokers: str, topic: str = DEFAULT_TOPIC, **extra: str) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": brokers, "topic": topic}
    opts.update({k if k.startswith("kafka.") else f"kafka.{k}": v for k, v in extra.items()})
    return opts


def next_offsets(messages: DataFrame) -> DataFrame:
    """``partition, next_offset``: where to go on after these messages."""
    return messages.groupBy("partition").agg((F.max("offset") + 1).cast("bigint").alias("next_offset"))


class OffsetLedger:
    """What has been read of a topic, one small file per micro-batch under ``path``."""

    _DDL = "partition int, next_offset bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commit(self, messages: DataFrame, batch_id: int) -> None:
        """Enter a batch; one that runs again enters the same again."""
        rows = next_offsets(messages).select(F.col("partition").cast("int").alias("partition"), "next_offset")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def after(self, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """A batch writer that enters each batch once ``write`` has written it: no message is passed over."""

        def both(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            try:
                write(batch, batch_id)
                self.commit(batch, batch_id)
            finally:
                batch.unpersist()

        return both

    def committed(self) -> dict[int, int]:
        """The next offset by partition: offsets only grow, so the largest counts."""
        if not any(n.startswith("batch_id=") for n in list_folder(self.spark, self.path)):
            return {}
        rows = self.spark.read.schema(self._DDL).parquet(self.path)
        rows = rows.groupBy("partition").agg(F.max("next_offset").alias("n"))
        return {r["partition"]: r["n"] for r in rows.collect()}  # one row per partition of the topic


def starting_offsets(
    committed: dict[int, int], topic: str = DEFAULT_TOPIC, partitions: Iterable[int] = (), otherwise: int = LATEST
) -> str:
    """Spark's ``startingOffsets``: the committed ones, and ``otherwise`` for the other ``partitions`` of the topic.

    With nothing committed and no partitions named this is plain ``latest`` or ``earliest``. Spark wants a
    position for every partition of the topic, so name those that may be new.
    """
    if otherwise not in (LATEST, EARLIEST):
        raise ValueError("otherwise must be LATEST or EARLIEST")
    if not committed:
        return "latest" if otherwise == LATEST else "earliest"
    places = {p: otherwise for p in partitions} | committed
    return json.dumps({topic: {str(p): places[p] for p in sorted(places)}})


def read_messages(
    spark: SparkSession,
    brokers: str,
    topic: str = DEFAULT_TOPIC,
    ledger: OffsetLedger | None = None,
    partitions: Iterable[int] = (),
    **extra: str,
) -> DataFrame:
    """Streaming ``(value, partition, offset)``: message text plus its position.

    With a ``ledger``, a query that has no checkpoint yet starts after the offsets entered there, else at the end.
    """
    if ledger is not None and "starting_offsets" not in extra:
        extra["starting_offsets"] = starting_offsets(ledger.committed(), topic, partitions)
    raw = spark.readStream.format("kafka").options(**kafka_source_options(brokers, topic, **extra)).load()
    return raw.select(F.col("value").cast("string").alias("value"), "partition", "offset")


def write_messages(events: DataFrame, brokers: str, topic: str = DEFAULT_TOPIC, checkpoint: str | None = None, **extra):
    """Keyless JSON messages to ``topic``: a batch write, or a started streaming query."""
    msgs = to_messages(events)
    opts = kafka_sink_options(brokers, topic, **extra)
    if not events.isStreaming:
        msgs.write.format("kafka").options(**opts).save()
        return None
    return msgs.writeStream.format("kafka").options(**opts).option("checkpointLocation", checkpoint).start()
