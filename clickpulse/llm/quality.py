"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Every text is reduced to a dozen statistics (``STATISTICS``).
2. A random forest of shallow trees is grown on the labelled rows. Each path from a
   root to a node is a rule: a conjunction of bounds on statistics.
3. A logistic regression with lasso penalty weighs the rules; most weights become 0.
4. What is left is compiled into one Spark column expression, which scores all rows.

Learning uses all labelled rows given, as Spark jobs; the driver sees trees and
weights only. With no labelled rows, or one class only, the score is the same for
all rows: (ones + 1) / (rows + 2).

Null and empty texts have all statistics 0 and get a score like any other.
Labels that are null do not teach; a document with several labels teaches each.
Rows without an id cannot be labelled but are scored. Repeated rows get equal scores. Columns
other than id and text are not read for a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import stored, with_workers
from clickpulse.llm.words import chunks, mix, shingle_hashes, word_hashes

#: Shares are of bytes or words as named; distinct and repeat shares are of words or five-word shingles.
STATISTICS = [
    "n_words", "bytes_per_word", "upper_bytes", "digit_bytes", "symbol_bytes", "mark_bytes", "exclamations_per_word",
    "bars_per_word", "lines_per_word", "distinct_words", "distinct_shingles", "repeats_previous", "one_byte_words",
]
TREES = 24
DEPTH = 3
LASSO = 0.002
SEED = 3

_CLASSES = {
    "upper": range(65, 91),
    "digit": range(48, 58),
    "symbol": [*range(35, 39), 42, 43, 47, *range(60, 65), *range(91, 97), 123, 125, 126],
    "mark": [33, 34, 39, 40, 41, 44, 45, 46, 58, 59],
    "exclamation": [33],
    "bar": [124],
    "line": [10],
}
_MASKS = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASSES.items()}


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[offsets])


def _distinct(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Distinct hashes of each row."""
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    keyed = hashes ^ mix(owner.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(keyed, return_index=True)
    return np.bincount(owner[first], minlength=len(rows) - 1)


def statistics_of(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    words, rows, start, end = word_hashes(raw, offsets)
    grams, parts = shingle_hashes(words, rows)
    n_bytes = np.maximum(np.diff(offsets), 1)
    n_words = np.diff(rows)
    least = np.maximum(n_words, 1)
    count = {k: _per_row(m[raw], offsets) for k, m in _MASKS.items()}
    owner = np.repeat(np.arange(len(n_words)), n_words)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    length = end - start
    by_row = lambda x: np.bincount(owner, weights=x, minlength=len(n_words))
    return np.column_stack(
        [
            n_words, by_row(length) / least, count["upper"] / n_bytes, count["digit"] / n_bytes, count["symbol"] / n_bytes,
            count["mark"] / n_bytes, count["exclamation"] / least, count["bar"] / least, count["line"] / least,
            _distinct(words, rows) / least, _distinct(grams, parts) / np.maximum(np.diff(parts), 1),
            by_row(same) / least, by_row(length == 1) / least,
        ]
    ).astype(np.float64)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [statistics_of(raw, offsets) for _, _, raw, offsets in chunks(batch["text"])]
        table = np.concatenate(found) if found else np.zeros((0, len(STATISTICS)))
        columns = [pa.array(np.ascontiguousarray(table[:, k])) for k in range(len(STATISTICS))]
        yield pa.record_batch([batch["doc_id"], *columns], names=["doc_id", *STATISTICS])


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of every row."""
    with_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_measure, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))


Rule = tuple[tuple[int, float, float], ...]
"""Bounds ``(statistic, above, up to)``, all of which must hold."""


def tree_rules(description: str) -> set[Rule]:
    """All paths of the trees that Spark's ``toDebugString`` describes."""
    rules: set[Rule] = set()
    path: list[tuple[int, dict[int, tuple[float, float]]]] = []
    step = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+)\)$")
    for line in description.splitlines():
        found = step.match(line)
        if not found:
            continue
        depth, feature, sign, value = len(found[1]), int(found[2]), found[3], float(found[4])
        while path and path[-1][0] >= depth:
            path.pop()
        bounds = dict(path[-1][1]) if path else {}
        low, high = bounds.get(feature, (-np.inf, np.inf))
        bounds[feature] = (low, min(high, value)) if sign == "<=" else (max(low, value), high)
        path.append((depth, bounds))
        rules.add(tuple((f, lo, hi) for f, (lo, hi) in sorted(bounds.items())))
    return rules


def rule_column(rule: Rule) -> Column:
    """Whether the rule holds, as 1.0 or 0.0."""
    holds = F.lit(True)
    for feature, low, high in rule:
        x = F.col(STATISTICS[feature])
        if low > -np.inf:
            holds = holds & (x > low)
        if high < np.inf:
            holds = holds & (x <= high)
    return F.when(holds, 1.0).otherwise(0.0)


def fit_rules(
    statistics: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id"
) -> tuple[Column, list[tuple[Rule, float]]]:
    """``(score column over the statistics, rules with their weights)`` learned from these labels."""
    marks = labels.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("doc_id"), (F.col(label_col) > 0).cast("double").alias("label")
    )
    rows = stored(statistics.join(marks, "doc_id"), "quality-labelled")
    count, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    constant = F.lit((ones + 1) / (count + 2))
    if ones in (0, count):
        return constant, []
    vectors = rows.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.7).fit(vectors)
    rules = sorted(tree_rules(forest.toDebugString))
    if not rules:
        return constant, []
    held = rows.select("label", array_to_vector(F.array(*map(rule_column, rules))).alias("features"))
    model = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60).fit(held)
    weighted = [(r, float(w)) for r, w in zip(rules, model.coefficients.toArray(), strict=True) if w != 0]
    total = F.lit(float(model.intercept))
    for rule, weight in weighted:
        total = total + rule_column(rule) * weight
    return 1 / (1 + F.exp(-total)), weighted


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    teaches: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.3,
) -> DataFrame:
    """``doc_id, score, predicted`` of every row; ``teaches`` picks the label rows to learn from."""
    measured = stored(text_statistics(docs, id_col, text_col), "quality-statistics")
    score, _ = fit_rules(measured, labels if teaches is None else labels.where(teaches), label_col, id_col)
    return measured.select("doc_id", score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, teaches: Column | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns; rows without an id stay."""
    bad = score_quality(docs, labels, teaches, id_col, text_col).where("predicted = 0")
    bad = bad.select(F.col("doc_id").alias("_drop")).distinct()
    return docs.join(bad, docs[id_col] == bad["_drop"], "left_anti")
