from __future__ import annotations

import zlib

import numpy as np
import pytest
from conftest import SF01
from llm_data import odd_rows, shingle_list, table, words
from pyspark.sql import functions as F

from clickpulse.llm import quality as Q
from clickpulse.llm.queries import LLM_QUERIES


def plain_statistics(text):
    raw = (text or "").encode()
    w = words(text)
    lengths = [len(x.encode()) for x in w]
    n, size = max(len(w), 1), max(len(raw), 1)
    count = lambda chars: sum(b in chars for b in raw)
    grams = shingle_list(w)
    return [
        len(w), sum(lengths) / n, count(range(65, 91)) / size, count(b"0123456789") / size, count(b"#$%&*+/<=>?@[\\]^_`{}~") / size,
        count(b"!\"'(),-.:;") / size, count(b"!") / n, count(b"|") / n, count(b"\n") / n, len(set(w)) / n,
        len(set(grams)) / max(len(grams), 1), sum(a == b for a, b in zip(w, w[1:], strict=False)) / n, lengths.count(1) / n,
    ]


def test_statistics(spark):
    rows = odd_rows(3_000)
    got = Q.text_statistics(table(spark, rows)).collect()
    want = [plain_statistics(t) for _, t, *_ in rows]
    by_key = sorted((str(r.doc_id), [r[s] for s in Q.STATISTICS]) for r in got)
    for (_, a), (_, b) in zip(by_key, sorted((str(r[0]), w) for r, w in zip(rows, want, strict=True)), strict=True):
        assert np.allclose(a, b)


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = LLM_QUERIES["op8_quality_classifier"](spark, SF01).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.95


def test_rules_are_the_paths_of_the_trees():
    text = (
        "Tree 0 (weight 1.0):\n  If (feature 2 <= 0.5)\n   If (feature 0 <= 1.0E-4)\n    Predict: 1.0\n"
        "   Else (feature 0 > 1.0E-4)\n    Predict: 0.0\n  Else (feature 2 > 0.5)\n   Predict: 0.0\n"
    )
    low = (2, -np.inf, 0.5)
    assert Q.tree_rules(text) == {(low,), ((0, -np.inf, 1e-4), low), ((0, 1e-4, np.inf), low), ((2, 0.5, np.inf),)}


def test_score_is_the_weighted_sum_of_the_rules(spark):
    docs = table(spark, [(k, ("word%d " % (k % 7)) * (3 + k % 5) if k % 2 else "!!! $$$ " * (2 + k % 4)) for k in range(200)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(150)] + [(3, None), (None, 1), (9999, 0)], "doc_id long, quality int")
    measured = Q.text_statistics(docs)
    score, weighted = Q.fit_rules(measured, labels)
    assert weighted
    rows = measured.withColumn("s", score).collect()
    base = None
    for r in rows:
        total = sum(w for rule, w in weighted if all(lo < r[Q.STATISTICS[f]] <= hi for f, lo, hi in rule))
        shift = np.log(r.s / (1 - r.s)) - total
        base = shift if base is None else base
        assert abs(shift - base) < 1e-6
    assert all((r.s >= 0.3) == bool(r.doc_id % 2) for r in rows)


@pytest.mark.parametrize(("marks", "score"), [([], 0.5), ([(4, 1), (6, 1)], 0.75)])
def test_no_labels_or_one_class(spark, marks, score):
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    rows = Q.score_quality(table(spark, odd_rows(100)), labels).collect()
    assert len(rows) == len(odd_rows()) and {r.score for r in rows} == {score}


def test_empty_table_and_columns(spark):
    labels = spark.createDataFrame([(4, 1), (6, 0)], "doc_id long, quality int")
    assert Q.score_quality(table(spark, []), labels).collect() == []
    docs = table(spark, odd_rows(100))
    kept = Q.keep_good(docs, labels.withColumn("quality", F.lit(0)))
    assert kept.columns == docs.columns
    # Three labelled rows (an id occurs once here), no ones: the score is 1 / 4 for all, below the threshold.
    assert {r.doc_id for r in kept.collect()} == {None}
