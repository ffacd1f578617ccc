"""Exact deduplication by skew-safe combining, with DataFrame functions only.

Rows are equal when their normalised texts are: the text without the characters
``[\\x20\\x09-\\x0D]``, null counting as empty. Of equal rows the one with the
most code points in its original text stays, ties going to the smallest id.

Every stage groups by the digest *and* the whole normalised text, so two texts
with one digest never merge:

1. local: Spark's partial aggregate folds the copies inside each input partition
   (all its rows carry one salt, so a group sends one row per partition);
2. salted: a group's rows meet in ``salts`` places, each giving one winner;
3. global: at most ``salts`` winners per group meet and give the final one.

Documents then learn their winner by digest alone. That is exact as long as a
digest stands for one text, which stage 3 has counted; digests that stand for
several are matched by digest and whole text.

Null ids are kept as rows of their own value; a null text equals an empty one;
repeated rows are copies like any others; an empty table gives an empty result;
columns other than id and text are never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import stored

SALTS = 32
WHITE_SPACE = "[\\x20\\x09-\\x0D]"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


#: Longest text first, then smallest id, packed into one number so that the aggregate
#: buffer has a fixed width: length * 2**64 + (2**63 - 1 - id) fits decimal(38).
_TWO_64 = "18446744073709551616"
_TOP = "9223372036854775807"


def _rank(id_col: str, text_col: str) -> Column:
    length = F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("decimal(10,0)")
    ident = F.col(id_col).cast("bigint").cast("decimal(19,0)")
    return (
        length * F.lit(_TWO_64).cast("decimal(20,0)") + (F.lit(_TOP).cast("decimal(19,0)") - ident)
    ).cast("decimal(38,0)")


def _id_of(rank: Column) -> Column:
    return (F.lit(_TOP).cast("decimal(19,0)") - rank % F.lit(_TWO_64).cast("decimal(20,0)")).cast("bigint")


def merge_copies(
    docs: DataFrame, id_col: str, text_col: str, salts: int, digest: Callable[[Column], Column]
) -> DataFrame:
    """One row per distinct normalised text: ``digest, text_norm, _rank, group_size``, partitioned by digest."""
    rows = docs.select(
        normalised(F.col(text_col)).alias("text_norm"),
        _rank(id_col, text_col).alias("_rank"),
        (F.spark_partition_id() % salts).alias("_salt"),
    ).withColumn("digest", digest(F.col("text_norm")))
    salted = rows.groupBy("_salt", "digest", "text_norm").agg(
        F.max("_rank").alias("_rank"), F.count(F.lit(1)).alias("_n")
    )
    return (
        salted.repartition("digest")
        .groupBy("digest", "text_norm")
        .agg(F.max("_rank").alias("_rank"), F.sum("_n").alias("group_size"))
    )


def mark_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256_hex,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Rows with one id are one document and are marked alike. A row without an id
    is kept only if its whole group has none.
    """
    merged = merge_copies(docs, id_col, text_col, salts, digest)
    # No shuffle: the rows are partitioned by digest already, and the texts stop here.
    classes = stored(
        merged.groupBy("digest").agg(
            F.count(F.lit(1)).alias("texts_of_digest"),
            F.max("_rank").alias("_rank"),
            F.max("group_size").alias("group_size"),
        ),
        "exact-classes",
    )
    text_norm = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_norm.alias("text_norm")).select(
        "doc_id", "text_norm", digest(F.col("text_norm")).alias("digest"), sha256_hex(F.col("text_norm")).alias("text_sha256")
    )
    single = classes.where("texts_of_digest = 1").select("digest", "_rank", "group_size")
    out = rows.drop("text_norm").join(single, "digest")
    shared = classes.where("texts_of_digest > 1").select("digest")
    if not shared.isEmpty():
        # Some digest stands for several texts: those rows are matched by their whole text.
        texts = merged.join(shared, "digest", "left_semi")
        out = out.unionByName(rows.join(texts, ["digest", "text_norm"]).drop("text_norm"))
    keep_id = _id_of(F.col("_rank"))
    return out.select(
        "doc_id",
        keep_id.alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = mark_copies(docs, id_col, text_col, salts).where("kept").select(F.col("doc_id").alias("_keep")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_keep"]), "left_semi")
