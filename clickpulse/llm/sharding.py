"""Proportional stratified interleaving: shards that all have the mixture of the whole.

Rows of each source (a stratum; null is a source of its own) are put in a seeded
random order. A row's fractional rank is its place in that order, shifted by a
seeded offset of its source and divided by the source's row count; sorting all
rows by it spreads each source evenly over the order. That order is cut into
shards of equal row count: the law is ``rows``, counts differ by one at most.

No stratum is ranked in one task. The seeded order is a hash, so its leading
bits cut every source into buckets of about ``bucket_rows`` rows; a row's rank is
its rank in its bucket plus the rows in earlier buckets, and the same holds for
the fractional ranks, which lie evenly in [0, 1). Only bucket counts are ever
summed in order.

A null text has no bytes (size 8, crc32 0). Rows that repeat an id are rows of
their own and get a slot each. An empty table gives an empty result. Columns
other than id, source and text are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import stored

SEED = 17
BUCKET_ROWS = 8_192
_RANGE = 1 << 52  # hash values used for order and offsets: exact as doubles


def assign_shards(
    docs: DataFrame,
    n_shards: int = 24,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``doc_id, source, size, text_crc32, shard, slot`` for every row."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    ).withColumn("_h", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit(seed)), F.lit(_RANGE)))
    # Read the texts once; everything below works on these few columns.
    rows = stored(rows, "shard-rows")
    total = max(rows.count(), 1)
    buckets = -(-total // bucket_rows)

    # Rank inside each source: rank in the bucket, plus the rows of the source's earlier buckets.
    width = -(-_RANGE // buckets)
    rows = rows.withColumn("_b", F.floor(F.col("_h") / F.lit(width)))
    per_bucket = rows.groupBy("source", "_b").agg(F.count(F.lit(1)).alias("_in"))
    in_order = Window.partitionBy("source").orderBy("_b")
    offsets = per_bucket.select(
        F.col("source").alias("_s"),
        F.col("_b").alias("_sb"),
        (F.sum("_in").over(in_order) - F.col("_in")).alias("_before"),
        F.sum("_in").over(Window.partitionBy("source")).alias("_of_source"),
    )
    order = ["_h", "doc_id", "size", "text_crc32"]
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy("source", "_b").orderBy(*order)) - 1)
    ranked = ranked.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_sb")))
    shift = F.pmod(F.xxhash64("source", F.lit(seed + 1)), F.lit(_RANGE)) / F.lit(float(_RANGE))
    ranked = ranked.withColumn("_f", (F.col("_r") + F.col("_before") + shift) / F.col("_of_source"))

    # Place in the whole order, in the same way over buckets of the fractional rank.
    ranked = ranked.withColumn("_g", F.least(F.floor(F.col("_f") * buckets), F.lit(buckets - 1)))
    starts = ranked.groupBy("_g").agg(F.count(F.lit(1)).alias("_in"))
    starts = starts.select(
        F.col("_g").alias("_sg"),
        # One row per bucket of bucket_rows rows: this window sees rows / bucket_rows rows.
        (F.sum("_in").over(Window.orderBy("_g")) - F.col("_in")).alias("_start"),
    )
    placed = ranked.withColumn(
        "_q", F.row_number().over(Window.partitionBy("_g").orderBy("_f", "source", *order)) - 1
    ).join(starts, F.col("_g") == F.col("_sg"))
    placed = placed.withColumn("_place", F.col("_q") + F.col("_start"))
    # Shard k holds the places from ceil(k * total / n) up to the next shard's first.
    placed = placed.withColumn("shard", F.expr(f"CAST((_place * {n_shards}) DIV {total} AS INT)"))
    slot = F.expr(f"_place - (CAST(shard AS BIGINT) * {total} + {n_shards - 1}) DIV {n_shards}")
    return placed.select("doc_id", "source", "size", "text_crc32", "shard", slot.alias("slot"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file."""
    assigned.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
