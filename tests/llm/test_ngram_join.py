from __future__ import annotations

import random
from itertools import permutations

import numpy as np
import pytest
from conftest import SF001
from llm_data import components, odd_rows, shingle_list, table, words

from clickpulse.llm import ngram_join as N
from clickpulse.llm.components import connected_components
from clickpulse.llm.queries import LLM_QUERIES


def want(rows):
    """Rows that repeat an id count as one document."""
    sets = {d: frozenset(shingle_list(words(t))) for d, t in rows if d is not None}
    comp = components(sets)
    return {(d, len(sets[d]), comp[d]) for d in sets}


def got(df):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()}


def test_query_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    out = LLM_QUERIES["op5_ngram_jaccard_join"](spark, SF001)
    assert got(out) == want(rows)


def edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def crowd():
    """Near copies with links and chains at the threshold, a passage that many share, and copies."""
    rng = random.Random(4)
    base = [f"b{k}" for k in range(90)]
    passage = [f"p{k}" for k in range(40)]
    rows = [(k, edited(rng, base, rng.randrange(0, 7))) for k in range(150)]
    rows += [(200 + k, " ".join([*passage, *(f"o{k}x{j}" for j in range(12))])) for k in range(60)]
    rows += [(300 + k, " ".join(passage[: 30 + k])) for k in range(11)]
    rows += [(400 + k, "the very same words in each of these " + "x" * (k % 2)) for k in range(40)]
    rows += [(500 + k, " ".join(f"c{j}" for j in range(k, k + 60))) for k in range(0, 40, 3)]
    return rows


@pytest.mark.parametrize("block", [N.BLOCK, 16], ids=["short lists", "blocks"])
def test_crowds_and_chains(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "PIVOTS", 2)
    rows = crowd()
    assert got(N.near_classes(table(spark, rows))) == want(rows)


def test_odd_rows(spark):
    rows = [r[:2] for r in odd_rows(3_000)]
    out = N.near_classes(table(spark, rows)).collect()
    assert len(out) == len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in out if r.doc_id is not None} == want(rows)
    docs = table(spark, rows)
    kept = N.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    firsts = {c for _, _, c in want(rows)}
    assert {r.doc_id for r in kept.collect()} == firsts | {None}


A = " ".join(f"a{k}" for k in range(30))
B = " ".join(f"b{k}" for k in range(30))


@pytest.mark.parametrize(
    "rows",
    list(permutations([(None, A), (1, A), (2, A + " extra tail")])) + [[(None, A), (None, A + " extra tail"), (2, A), (3, A)]],
)
def test_rows_without_an_id_hide_nothing(spark, rows):
    out = N.near_classes(table(spark, rows).coalesce(1)).collect()
    assert {(r.doc_id, r.component_id) for r in out if r.doc_id is not None} == {(d, c) for d, _, c in want(rows)}
    assert all(r.component_id is None and r.class_id is None for r in out if r.doc_id is None) and len(out) == len(rows)


def test_ids_with_several_texts(spark):
    """Both texts of 1 keep their links, and 1 puts 2 and 3 into one component."""
    rows = [(1, A), (1, B), (2, A + " tail"), (3, B + " tail"), (9, "x"), (9, None), (9, "x"), (None, B), (8, "X")]
    rows += [(20 + k, " ".join(f"c{k}x{j}" for j in range(30))) for k in range(5)]
    for order in (rows, rows[::-1]):
        out = N.near_classes(table(spark, order).coalesce(1)).collect()
        assert len(out) == len(rows)
        found = {(r.doc_id, r.n_shingles, r.component_id) for r in out if r.doc_id is not None}
        assert found == {(1, 26, 1), (2, 27, 1), (3, 27, 1), (9, 1, 8), (9, 0, 9), (8, 1, 8)} | {
            (20 + k, 26, 20 + k) for k in range(5)
        }
    docs = table(spark, rows)
    kept = {r.doc_id for r in N.keep_one_of_each(docs).collect()}
    assert kept == {1, 8, None} | {20 + k for k in range(5)}


def test_empty_table(spark):
    assert N.near_classes(table(spark, [])).collect() == []
    assert got(N.near_classes(table(spark, [(1, ""), (2, None)]))) == {(1, 0, 1), (2, 0, 2)}


def test_prefix_filter_and_its_choice_of_length():
    assert [N.required(n) for n in (1, 4, 5, 6, 100)] == [1, 4, 4, 5, 80]
    assert N.matches(np.array([1, 16, 17, 160])).tolist() == [1, 1, 2, 10]
    # Rare tokens: nothing to gain. Frequent ones: a longer prefix costs less than its candidates.
    assert N.best_matches(np.full(100, 2), 100, 80) >= 1
    few = N.best_matches(np.array([2] * 21 + [1000] * 79), 100, 80)
    many = N.best_matches(np.full(1000, 50), 1000, 800)
    assert few == 1 and many > 1


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001), (7, 7), (3, 2)], "a long, b long")
    out = {r.node: r.component for r in connected_components(links, "test").collect()}
    assert out == {k: 0 for k in range(301)} | {1000: 1000, 1001: 1000}
