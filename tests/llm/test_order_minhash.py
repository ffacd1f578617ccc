from __future__ import annotations

import hashlib
import random
import re

import pytest
import xxhash
from conftest import SF001, SF01
from llm_data import SPACE, odd_rows, table
from pyspark.sql import functions as F

from clickpulse.llm.order_minhash import fingerprint_text, fingerprints, likeness, signature, with_neighbours
from clickpulse.llm.queries import LLM_QUERIES, neighbour_digest

ENTRIES, TUPLE = 64, 2


def xx(data, seed=42):
    return xxhash.xxh64(data, seed=seed % 2**64).intdigest()


def long_bytes(h):
    return (h % 2**64).to_bytes(8, "little")


def signed(h):
    return h - 2**64 if h >= 2**63 else h


def kmers(text):
    hashes = [xx(w.encode()) for w in re.findall(f"[^{SPACE}]+", text)]
    out = []
    for i in range(max(len(hashes) - 4, min(len(hashes), 1))):
        h = 42
        for w in hashes[i : i + 5]:
            h = xx(long_bytes(w), h)
        out.append(signed(h))
    return out


def brute(text):
    """Entries by ranking all occurrence-numbered k-mers anew from each mark."""
    runs = kmers(text)
    low = 2 ** len(bin(len(runs))[2:])
    seen, ranked = {}, []
    for place, kmer in enumerate(runs, 1):
        seen[kmer] = seen.get(kmer, 0) + 1
        ranked.append((kmer - kmer % low + place, place, kmer, seen[kmer]))
    out = []
    for m in range(ENTRIES):
        mark = -(2**63) + m * 2**64 // ENTRIES
        first = sorted(ranked, key=lambda r: (r[0] - mark) % 2**64)[:TUPLE]
        h = 0
        for _, place, kmer, occurrence in sorted(first, key=lambda r: r[1]):
            kmer_hash = xx(occurrence.to_bytes(4, "little"), xx(long_bytes(kmer)))
            h = xx(long_bytes(kmer_hash), xx(long_bytes(h)))
        out.append(h % 2**32)
    return "".join(f"{h:08x}" for h in out)


def like(a, b):
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, 8 * ENTRIES, 8)) / ENTRIES


def brute_digest(rows):
    """All columns of the query; rows that repeat id and text are one document."""
    key = lambda d, t: hashlib.sha256(f"{'' if d is None else d}:{t}".encode()).hexdigest()
    texts = {key(d, t or ""): (d, t or "") for d, t, *_ in rows}
    order = sorted(texts, key=lambda k: (texts[k][0] is None, -(texts[k][0] or 0), k))
    cache = {}

    def sign(t):
        if t not in cache:
            cache[t] = brute(t)
        return cache[t]

    out = {}
    for i, k in enumerate(order):
        d, t = texts[k]
        following = texts[order[(i + 1) % len(order)]][1]
        n = len(t)
        edited = t[: n - n // 3] + following[: n // 3]
        out[k] = (
            d,
            n,
            hashlib.sha256(edited.encode()).hexdigest(),
            sign(t),
            sign(edited),
            like(sign(t), sign(edited)),
            like(sign(t), sign(following)),
        )
    return sorted((out[key(d, t or "")] for d, t, *_ in rows), key=str)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = [tuple(r) for r in docs]
    if sf == SF01:
        rows = [r for r in rows if len(r[1] or "") < 600]
        got = neighbour_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    else:
        got = LLM_QUERIES["op13_order_minhash"](spark, sf).collect()
    assert sorted(map(tuple, got), key=str) == brute_digest(rows)


def test_odd_rows(spark):
    rows = odd_rows(3_000) + [(5, "other text of one id"), (None, None), (None, ""), (20, "a b c d e " * 50)]
    random.Random(2).shuffle(rows)
    got = neighbour_digest(table(spark, rows).repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == brute_digest(rows)
    plain = fingerprints(table(spark, rows)).collect()
    assert sorted(map(tuple, plain), key=str) == sorted(((d, brute(t or "")) for d, t, *_ in rows), key=str)


@pytest.mark.parametrize("rows", [[], [(1, "only one of them")], [(1, None)], [(None, "a"), (None, "a")]])
def test_few_rows(spark, rows):
    got = neighbour_digest(table(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute_digest(rows)


def test_falls_with_edits_and_sees_order(spark):
    rng = random.Random(7)
    base = [f"w{rng.randrange(5000)}" for _ in range(600)]

    def changed(share):
        return " ".join(f"x{rng.random()}" if rng.random() < share else w for w in base)

    halves = " ".join(base[300:] + base[:300])
    blocks = [base[i : i + 20] for i in range(0, 600, 20)]
    rng.shuffle(blocks)
    texts = [" ".join(base), changed(0.005), changed(0.03), changed(0.3), halves, " ".join(sum(blocks, []))]
    docs = spark.createDataFrame([(" ".join(base), t) for t in texts], "a string, b string")
    near = [r[0] for r in docs.select(likeness(signature(F.col("a")), signature(F.col("b")))).collect()]
    assert near[0] == 1.0 and near[0] > near[1] > near[2] > near[3] and near[3] < 0.05
    # Shuffled passages keep most five-word runs, yet count as a change.
    assert near[5] < 0.75 * (1 - 30 * 4 / 596) and near[4] < 1.0


def test_no_python_in_the_plan(spark):
    docs = table(spark, odd_rows(200))
    for df in (with_neighbours(docs), docs.select(fingerprint_text(signature(F.coalesce("text", F.lit("")))))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
