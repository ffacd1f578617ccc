from __future__ import annotations

import re

import corpus_pipeline as P
import sentencepiece
from conftest import SF001, SF01
from llm_data import components, leaks, odd_rows, shingle_list, table, words

import __spark_entry__ as entry
from clickpulse.llm.queries import LLM_QUERIES
from clickpulse.llm.sentencepiece_codec import MODEL


def test_run_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()}
    left = dict(docs)
    # The classifier's decisions are tested by its held-out accuracy; here they must take effect.
    good = {r.doc_id for r in LLM_QUERIES["op8_quality_classifier"](spark, SF001).collect() if r.predicted == 1}
    left = {d: t for d, t in left.items() if d in good}
    best: dict[str, int] = {}
    for d in sorted(left, key=lambda d: (-len(left[d] or ""), d)):
        best.setdefault(re.sub("[\x20\x09-\x0d]", "", left[d] or ""), d)
    left = {d: left[d] for d in best.values()}
    comp = components({d: frozenset(shingle_list(words(t))) for d, t in left.items()})
    left = {d: t for d, t in left.items() if comp[d] == d}
    bad = {d for d, _ in leaks(left, items)}
    left = {d: t for d, t in left.items() if d not in bad}
    rows = P.run(spark, SF001).collect()
    assert {r.doc_id for r in rows} == set(left) and len(rows) == len(left)
    reference = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert all(r.ids == reference.encode(left[r.doc_id] or "") and r.round_trip and r.n_ids == len(r.ids) for r in rows)


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = table(spark, odd_rows(500))
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF01).columns == docs.columns
        assert stage(spark, table(spark, []), SF01).collect() == []


def test_registered():
    names = list(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
