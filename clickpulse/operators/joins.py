"""Lookup joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join a lookup table onto a large (possibly streaming) table.

    No hint and no counting: Spark broadcasts ``small`` when the size in its plan statistics
    (or, at run time, the size of its finished stage) is within
    ``spark.sql.autoBroadcastJoinThreshold``, and otherwise shuffles both sides on the key, where
    adaptive execution splits the partitions of hot keys.

    A static side beyond the threshold is shuffled again in every micro-batch of a stream. Store
    such a table bucketed by the key (``bucketBy``) so only the stream side moves.
    """
    return big.join(small, on, how)
