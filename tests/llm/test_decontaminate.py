from __future__ import annotations

import random

import numpy as np
from conftest import SF001
from llm_data import leaks, odd_rows, table

from clickpulse.llm import decontaminate as D
from clickpulse.llm.queries import LLM_QUERIES

ITEMS = "item_id long, text string, doc_id long"


def found(df):
    return {(r.doc_id, r.item_id): (r.similarity, r.word_start, r.windows) for r in df.collect()}


def test_query_equals_all_windows(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()}
    assert found(LLM_QUERIES["op3_benchmark_decontamination"](spark, SF001)) == leaks(docs, items)


def near_cases():
    rng = random.Random(8)
    vocab = [f"v{k}" for k in range(400)]
    items = {k: " ".join(rng.choices(vocab, k=n)) for k, n in enumerate([1, 2, 4, 5, 6, 12, 30, 30, 59, 59, 200])}
    items[11], items[12], items[13] = None, " ", items[6]
    docs = {}
    for d in range(120):
        item = (items[rng.randrange(11)] or "").split()
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(item)) if item else 0
            item[at : at + rng.randrange(0, 2)] = rng.choices(vocab, k=rng.randrange(0, 2))
        around = rng.choices(vocab, k=rng.choice([0, 3, 40]))
        docs[d] = " ".join([*around, *item, *rng.choices(vocab, k=rng.choice([0, 10]))])
    docs[500] = " ".join(["again"] * 300)
    items[20] = " ".join(["again"] * 25)
    return docs, items


def test_edited_short_long_and_repeated_items(spark):
    docs, items = near_cases()
    want = leaks(docs, items)
    df = table(spark, docs.items())
    bench = spark.createDataFrame([(i, t, 7) for i, t in items.items()], ITEMS)
    assert found(D.contaminated(df, bench)) == want
    assert len(want) > 60 and any(0.8 <= v[0] < 0.9 for v in want.values())
    # The benchmark in several blocks gives the same.
    assert found(D.contaminated(df, bench, block_bytes=600)) == want
    kept = {r.doc_id for r in D.decontaminate(df, bench).collect()}
    assert kept == set(docs) - {d for d, _ in want}


def test_sums_of_windows_with_many_copies():
    rng = np.random.default_rng(5)
    for n, size, kinds in ((40, 7, 3), (40, 40, 2), (9, 1, 2), (300, 25, 1), (120, 30, 100), (50, 8, 90)):
        h = rng.integers(1, 2**63, kinds, dtype=np.uint64)[rng.integers(0, kinds, n)]
        got = D.window_sums(h, size)
        if kinds >= n:
            distinct = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            assert (D.window_sums(distinct, size) == D.window_sums(distinct, size, False)).all()
        assert len(got) == n - size + 1
        for k in range(n - size + 1):
            seen, features = {}, []
            for x in h[k : k + size].tolist():
                seen[x] = seen.get(x, 0) + 1
                features.append((x, seen[x]))
            x, c = (np.array(v, np.uint64) for v in zip(*features, strict=True))
            assert (got[k] == D._bits(D._features(x, c)).sum(axis=0)).all()


def test_items_of_few_heavy_shingles_at_the_threshold(spark):
    """Two alternating words and one other: windows of similarity 0.8 exactly, and just above and below."""
    rng = random.Random(12)
    docs, items = {}, {}
    for k in range(400):
        a, b, c, d = (f"{x}{k}" for x in "abcd")
        words = [a, b] * 6 + [a]
        items[k] = " ".join(words if k % 2 else [*words[:12], c])
        near = items[k].split()
        if k % 4 < 2:
            near[-1] = d  # one shingle of nine differs
        else:
            near[rng.randrange(13)] = d
        docs[k] = " ".join([*(f"x{k}y{j}" for j in range(rng.randrange(6))), *near, "tail", "of", "it"])
    want = leaks(docs, items)
    bench = spark.createDataFrame([(i, t, 7) for i, t in items.items()], ITEMS)
    assert found(D.contaminated(table(spark, docs.items()), bench)) == want
    assert sum(v[0] == 0.8 for v in want.values()) > 150


def test_recall_at_the_threshold_by_length():
    """Windows with a ninth of their features replaced: how many lie within the radius."""
    rng = np.random.default_rng(9)
    for m in (9, 18, 45, 90, 198):
        for heavy in (m, 3):
            base = rng.integers(1, 2**63, (2000, heavy), dtype=np.uint64)
            h = np.concatenate([base] * -(-m // heavy), axis=1)[:, :m]
            changed = h.copy()
            changed[:, m - m // 9 :] = rng.integers(1, 2**63, (2000, 1), dtype=np.uint64)
            far = 0
            for x, y in zip(h, changed, strict=True):
                p, q = (D._fingerprints(D.window_sums(v, m)) for v in (x, y))
                far += int(np.bitwise_count(p ^ q)[0]) > D.RADIUS
            assert far <= 1, (m, heavy, far)


def test_no_fingerprint_within_the_radius_is_missed():
    rng = np.random.default_rng(2)
    index = D.ItemIndex([(k, rng.integers(1, 2**63, 8, dtype=np.uint64)) for k in range(50)])
    prints = []
    for _ in range(400):
        base = int(index.prints[rng.integers(50)])
        for bit in rng.choice(64, rng.integers(0, 30), replace=False):
            base ^= 1 << int(bit)
        prints.append(base)
    prints = np.array(prints, np.uint64)
    which, item = index.candidates(prints)
    near = np.bitwise_count(prints[:, None] ^ index.prints[None, :]) <= D.RADIUS
    assert set(zip(which.tolist(), item.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_odd_rows_and_empty_tables(spark):
    prose = odd_rows()[3][1]
    bench = spark.createDataFrame([(1, prose, 0), (2, "one two", 0), (3, None, 0), (None, prose, 0)], ITEMS)
    df = table(spark, odd_rows())
    got = {(r.doc_id, r.item_id) for r in D.contaminated(df, bench).collect()}
    ids = {4, 5, 6, None}
    assert got == {(d, i) for d in ids for i in (1, None)} | {(7, 2), (8, 2)}
    out = D.decontaminate(df, bench)
    assert out.columns == df.columns
    # Rows without an id cannot be told apart and stay.
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r[0]) for r in odd_rows() if r[0] not in (4, 5, 6, 7, 8))
    assert D.contaminated(table(spark, []), bench).collect() == []
    assert D.contaminated(df, bench.limit(0)).collect() == []
