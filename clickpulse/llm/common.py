"""Helpers shared by the operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickpulse.session import scratch_path, ship_package


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def with_workers(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers."""
    ship_package(spark)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table under ``spark.checkpoint.dir`` and read it back.

    This cuts lineage and keeps one result for several readers; it survives the
    loss of executors. The files stay there until the folder's owner clears it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_of_id(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``: the folds of the contracts."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def bit_table(spots: Column, of: DataFrame, bits: int) -> np.ndarray:
    """A table of ``bits`` bits (a power of two, at least 2**15) with the bits at ``spots`` of the rows set.

    A filter of fixed size that travels to the tasks, whatever the number of rows: the
    executors build it in pieces of 4 kB, and the driver only joins these.
    """
    place = of.select((spots + 1).alias("p"))  # Spark's bitmaps count from 1
    pieces = place.groupBy(F.bitmap_bucket_number("p").alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("piece")
    )
    out = np.zeros(bits // 8, np.uint8)
    for row in pieces.collect():
        piece = np.frombuffer(row["piece"], np.uint8)
        at = (row["k"] - 1) * len(piece)
        out[at : at + len(piece)] = piece
    return out


def bits_set(table: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """Whether the bit at each spot is set."""
    return (table[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1 == 1


def running(df: DataFrame, keys: list[str], bucket: Column, order: list[str], **values: tuple[str, str]) -> DataFrame:
    """``df`` with inclusive running aggregates, by ``keys`` in the order of ``order``.

    ``values`` maps a new column to ``(column, "sum" or "xor")``. ``bucket`` (an integer that never
    falls along the order) cuts long runs: each bucket is sorted in a task of its own, and only
    the buckets' totals of a key meet.
    """
    fold = {"sum": F.sum, "xor": F.bit_xor}
    cut = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = cut.select("*", *[fold[how](c).over(inside).alias(f"_in_{name}") for name, (c, how) in values.items()])
    totals = cut.groupBy(*keys, "_bucket").agg(*[fold[how](c).alias(f"_all_{name}") for name, (c, how) in values.items()])
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *keys,
        "_bucket",
        *[
            F.coalesce(fold[how](f"_all_{name}").over(before), F.lit(0)).alias(f"_off_{name}")
            for name, (_, how) in values.items()
        ],
    )
    out = []
    for name, (_, how) in values.items():
        a, b = F.col(f"_in_{name}"), F.col(f"_off_{name}")
        out.append((a + b if how == "sum" else a.bitwiseXOR(b)).alias(name))
    return rows.join(totals, [*keys, "_bucket"]).select(*df.columns, *out)
