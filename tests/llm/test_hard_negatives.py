from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import SF001, SF01
from oracle import duck, duck_rows, fingerprint, spark_rows
from pyspark.sql import functions as F

from clickpulse.llm.hard_negatives import mine, score_bounds, whole_vectors
from clickpulse.llm.queries import LLM_ORACLE, LLM_QUERIES, mined_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, norm string, angles int, `rank` int, _a int, _r int"


def table(spark, rows):
    """``embeddings`` with further columns whose names the operator also uses inside."""
    return spark.createDataFrame([(*r, "v", "n", 1, 2, 3, 4) for r in rows], SCHEMA)


def brute(rows):
    known = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in vector]
        if sum(x * x for x in q) >= 2**62:
            continue
        row = ((label + 1) % 10 if vec_id % 7 == 0 else label, q)
        known[vec_id] = min(known.get(vec_id, row), row)
    out = []
    for a, (label, q) in known.items():
        if a % 50:
            continue
        scores = sorted(
            (-sum(x * y for x, y in zip(q, other[1], strict=True)), b, other[0] == label)
            for b, other in known.items()
            if b != a and len(other[1]) == len(q)
        )
        for s, p, _ in [x for x in scores if x[2]][:5]:
            fits = [(-n, b) for n, b, same in scores if not same and 50 * -s <= 100 * -n <= 95 * -s][:3]
            out += [(a, p, k + 1, b, -s, n) for k, (n, b) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_equals_sql(spark, sf):
    got = fingerprint(*spark_rows(LLM_QUERIES["op12_hard_negatives"](spark, sf)))
    assert got == fingerprint(*duck_rows(duck(sf), LLM_ORACLE["op12_hard_negatives"]))


def odd_vectors():
    rng = random.Random(5)
    rows = [
        (None, [1.0, 2.0], 1),
        (50, [1.0, 2.0], None),
        (100, None, 1),
        (150, [1.0, None], 1),
        (151, [1.0, float("nan")], 1),
        (152, [1.0, float("inf")], 1),
        (153, [3.0e38, -3.0e38], 1),
        (250, [], 1),
        (251, [], 1),
        (252, [], 2),
        (300, [0.0, 0.0], 3),
        (301, [0.0, 0.0], 3),
        (302, [0.0, 0.0], 4),
        (350, [-1.0, -1.0], 5),
        (351, [1.0, 1.0], 5),
        (352, [0.5, 0.5], 6),
        (400, [1000.0, 2000.0, 3.0], 7),
        (401, [900.0, 2000.0, 4.0], 7),
        (402, [700.0, 1500.0, 4.0], 8),
        (450, [4.0e6, 1.0e6], 1),
        (451, [4.0e6, 2.0e6], 1),
        (453, [2.0e6, 2.0e6], 2),
    ]
    hot = [0.25] * 8
    for i in range(1000, 1400):
        rows.append((i, hot if i % 3 == 0 else [rng.gauss(0, 0.3) for _ in range(8)], rng.randrange(10)))
    return rows + [(1050, [0.1] * 8, 3), (1050, [0.1] * 8, 2), rows[-1], rows[-1]]


@pytest.mark.parametrize("block", [4096, 50])
def test_odd_rows_ties_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr("clickpulse.llm.hard_negatives.BLOCK_ROWS", block)
    rows = odd_vectors()
    got = mined_negatives(table(spark, rows).repartition(4)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


@pytest.mark.parametrize("references", [0, 1, 30])
def test_references_do_not_change_results(spark, references):
    rows = [r for r in odd_vectors() if r[0] and r[0] >= 1000]
    vectors = whole_vectors(table(spark, rows), "vec_id", F.col("label"), "embedding", 256)
    got = mine(vectors, F.col("vec_id") % 50 == 0, references=references).collect()
    plain = mine(vectors, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain)) and got


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(500, 6)))
    x[250:] = np.floor(x[:250] * rng.uniform(0.5, 2, (250, 1)) + rng.normal(size=(250, 6)))
    norm = np.linalg.norm(x, axis=1)
    r = x[:12]
    angles = np.arccos(np.clip(x @ r.T / np.outer(norm, norm[:12]), -1, 1))
    cut = 0
    for i in range(500):
        low, high = score_bounds(norm[i], angles[i], norm, angles)
        s = x @ x[i]
        assert (low <= s).all() and (s <= high).all()
        cut += (high < 0.5 * norm[i] * norm).sum()
    assert cut > 20_000


def test_empty_table(spark):
    assert mined_negatives(table(spark, [])).collect() == []
    assert mined_negatives(table(spark, [(50, [1.0], 1)])).collect() == []
