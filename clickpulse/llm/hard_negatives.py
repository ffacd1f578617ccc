"""Hard-negative mining by angular triangle filtering.

Every vector is stored with its norm and its angles to a few reference directions. For
an anchor a, a row x and a reference r, the angle between a and x lies between
|angle(a, r) - angle(x, r)| and angle(a, r) + angle(x, r) (or its complement to a whole turn). All references
together give an interval of the cosine; times the norms, and widened by more than rounding can
take, an interval of the integer score. Only rows whose interval overlaps what the anchor is looking
for get their score computed:

1. positives: rows of the anchor's label that may reach the fifth best of the lower bounds;
2. negatives: rows of other labels that may fall between ``LEAST`` and ``MOST`` percent of a positive's score.

Rows and anchors are dealt to blocks of bounded size, and each block of rows meets each block of anchors in a
task; a block sends on its few best rows for each anchor, which are ranked over all blocks. Nothing grows
in a task but the number of such pairs of blocks. The bounds decide only what is left out: scores are
integers, so results do not depend on the references.

Rows take no part if their id, label or vector is null, a component is null or not finite, or
the vector is so long that scores would not fit 64 bits (2**31). Rows with vectors of different length have no
score with each other. Rows that repeat an id are one: the least by label, then components. Empty vectors score 0.
An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import stored, with_workers

POSITIVES, NEGATIVES = 5, 3
#: A negative has between so many percent of the positive's score.
LEAST, MOST = 50, 95
REFERENCES = 8
#: Rows and anchors of one block.
BLOCK_ROWS = 4096
#: Relative and absolute width by which score bounds are widened; angles are good to 1e-7.
SLACK, SLACK_SCORE = 1e-6, 1.0
_LONGEST = float(2**31)
#: Below this product of norms, floating point holds every partial sum of a score exactly.
_EXACT = float(2**52)

_ROW = "vec_id long, label long, vector array<long>, norm double, angles array<double>"


def whole_vectors(rows: DataFrame, id_col: str, label: Column, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, label, vector``: usable rows, components scaled and rounded down."""
    vector = F.col(vector_col).cast("array<double>")
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(usable)
    known = known.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        label.cast("bigint").alias("label"),
        F.transform(vector, lambda x: F.floor(x * scale)).alias("vector"),
    ).where("label IS NOT NULL")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    known = known.where(square < _LONGEST * _LONGEST)
    one = known.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return one.select("vec_id", "row.label", "row.vector")


def _matrix(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, matrix)`` for each length of vector."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lengths = np.asarray(lists.value_lengths().fill_null(0))
    flat = np.asarray(lists.flatten())
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield rows, flat[starts[rows][:, None] + np.arange(d)[None, :]]


def _with_angles(references: list[list[int]]):
    """Adds ``norm`` and ``angles``; an angle to a reference of another length, or of a zero vector, is unknown (NaN)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norm = np.zeros(batch.num_rows)
            angles = np.full((batch.num_rows, len(references)), np.nan)
            for rows, q in _matrix(batch["vector"]):
                x = q.astype(np.float64)
                norm[rows] = np.sqrt((x * x).sum(axis=1))
                for k, reference in enumerate(references):
                    r = np.asarray(reference, np.float64)
                    size = np.sqrt((r * r).sum())
                    if len(r) == x.shape[1] and size > 0:
                        with np.errstate(invalid="ignore", divide="ignore"):
                            angles[rows, k] = np.arccos(np.clip(x @ r / (norm[rows] * size), -1, 1))
            flat = pa.array(angles.ravel(), pa.float64())
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(references))
            yield pa.record_batch(
                [*batch.columns, pa.array(norm), pa.ListArray.from_arrays(offsets, flat)],
                names=["vec_id", "label", "vector", "norm", "angles"],
            )

    return run


def store_angles(vectors: DataFrame, references: int = REFERENCES) -> DataFrame:
    """The vectors with norms and angles to ``references`` of them, the ones with the least hashed ids."""
    vectors = stored(vectors, "negatives-vectors")
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(references).select("vector").collect()
    return stored(vectors.mapInArrow(_with_angles([r["vector"] for r in chosen]), _ROW), "negatives-angles")


def score_bounds(norm: float, angles: np.ndarray, norms: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores that an anchor cannot be below or above with rows of these norms and angles."""
    if of.shape[1]:
        apart, both = np.abs(of - angles), of + angles
        least = np.fmax.reduce(apart, axis=1)
        most = np.fmin.reduce(np.minimum(both, 2 * np.pi - both), axis=1)
    else:
        least = most = np.full(len(norms), np.nan)
    least, most = np.nan_to_num(least, nan=0.0), np.nan_to_num(most, nan=np.pi)
    size = norm * norms
    slack = SLACK * size + SLACK_SCORE
    return size * np.cos(most) - slack, size * np.cos(least) + slack


class _Rows:
    """Rows of one block and one vector length as arrays."""

    def __init__(self, table: pa.Table, rows: np.ndarray, q: np.ndarray):
        self.id = table["vec_id"].to_numpy()[rows]
        self.label = table["label"].to_numpy()[rows]
        self.norm = table["norm"].to_numpy()[rows]
        self.whole = q
        self.real = q.astype(np.float64)
        self.longest = self.norm.max(initial=0.0)
        lists = table["angles"].combine_chunks()
        self.angles = np.asarray(lists.flatten().fill_null(np.nan)).reshape(table.num_rows, -1)[rows]

    def scores(self, anchor: _Rows, i: int, rows: np.ndarray) -> np.ndarray:
        """Integer scores, in floating point where that is exact."""
        if anchor.norm[i] * self.longest < _EXACT:
            return (self.real[rows] @ anchor.real[i]).astype(np.int64)
        return self.whole[rows] @ anchor.whole[i]


def _by_length(table: pa.Table) -> dict[int, tuple[np.ndarray, _Rows]]:
    return {q.shape[1]: (rows, _Rows(table, rows, q)) for rows, q in _matrix(table["vector"])} if table.num_rows else {}


def _meet(anchors: pa.Table, rows: pa.Table):
    """``(number of the anchor in the table, anchors, number in them, rows)`` for anchors and rows of one length."""
    others = _by_length(rows)
    for length, (numbers, own) in _by_length(anchors).items():
        if length in others:
            for i, number in enumerate(numbers):
                yield number, own, i, others[length][1]


def _best(score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    if len(score) > 4 * count:
        least = np.partition(score, len(score) - count)[len(score) - count]
        some = np.flatnonzero(score >= least)
        return some[np.lexsort((ids[some], -score[some]))[:count]]
    return np.lexsort((ids, -score))[:count]


def _table(columns: list[list[np.ndarray]], names: list[str]) -> pa.Table:
    whole = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    return pa.table([pa.array(c.astype(np.int64)) for c in whole], names=names)


def _find_positives(count: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        for _, own, i, x in _meet(anchors, rows):
            some = np.flatnonzero((x.label == own.label[i]) & (x.id != own.id[i]))
            if len(some) > count:
                low, high = score_bounds(own.norm[i], own.angles[i], x.norm[some], x.angles[some])
                some = some[high >= np.partition(low, len(low) - count)[len(low) - count]]
            score = x.scores(own, i, some)
            best = _best(score, x.id[some], count)
            for c, v in zip(out, (np.full(len(best), own.id[i]), x.id[some][best], score[best]), strict=True):
                c.append(v)
        return _table(out, ["anchor_id", "positive_id", "positive_score"])

    return run


def _find_negatives(count: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        wanted = anchors["wanted"].combine_chunks()
        for number, own, i, x in _meet(anchors, rows):
            pairs = [(w["positive_id"], w["positive_score"]) for w in wanted[int(number)].as_py()]
            pairs = [(p, s) for p, s in pairs if s >= 0]  # below zero, nothing lies between the bounds
            if not pairs:
                continue
            some = np.flatnonzero(x.label != own.label[i])
            low, high = score_bounds(own.norm[i], own.angles[i], x.norm[some], x.angles[some])
            least, most = min(s for _, s in pairs), max(s for _, s in pairs)
            some = some[(100 * high >= LEAST * float(least)) & (100 * low <= MOST * float(most))]
            score = x.scores(own, i, some)
            for p, s in pairs:
                # Integer bounds: LEAST * s <= 100 * score <= MOST * s.
                fits = np.flatnonzero((score >= -(-LEAST * s // 100)) & (score <= MOST * s // 100))
                best = fits[_best(score[fits], x.id[some[fits]], count)]
                n = len(best)
                row = (np.full(n, own.id[i]), np.full(n, p), x.id[some[best]], score[best])
                for c, v in zip(out, row, strict=True):
                    c.append(v)
        return _table(out, ["anchor_id", "positive_id", "negative_id", "negative_score"])

    return run


def _in_blocks(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, find, schema: str) -> DataFrame:
    """Each block of anchors meets each block of rows once."""
    a, r = -(-n_anchors // BLOCK_ROWS), -(-n_rows // BLOCK_ROWS)

    def nr(count: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(count))

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))

    # Renamed to the same names: both sides come from one table, and their columns must not be confused.
    left = anchors.toDF(*anchors.columns).select("*", nr(a).alias("_a"), every(r).alias("_r"))
    right = rows.select("*", nr(r).alias("_r"), every(a).alias("_a"))
    return left.groupBy("_a", "_r").cogroup(right.groupBy("_a", "_r")).applyInArrow(find, schema)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, references: int = REFERENCES
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``vec_id, label, vector`` rows."""
    with_workers(vectors.sparkSession)
    rows = store_angles(vectors, references)
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("a")).first()
    n, a = max(1, sizes["n"]), max(1, sizes["a"])
    anchors = rows.where(is_anchor)

    found = _in_blocks(
        anchors, rows, a, n, _find_positives(positives), "anchor_id long, positive_id long, positive_score long"
    )
    first = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    found = found.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= positives).drop("_k")
    found = stored(found, "negatives-positives")

    wanted = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("wanted")
    )
    out = _in_blocks(
        anchors.join(wanted, "vec_id"),
        rows,
        a,
        n,
        _find_negatives(negatives),
        "anchor_id long, positive_id long, negative_id long, negative_score long",
    )
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    out = out.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return out.join(found, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
