from __future__ import annotations

import hashlib
import random
import tracemalloc

import pyarrow as pa
import pytest
import sentencepiece
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import odd_rows, table

from clickpulse.llm.queries import LLM_QUERIES, codec_digest
from clickpulse.llm.sentencepiece_codec import MODEL, decode_documents, encode_documents, piece_model

reference = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same(texts):
    got = piece_model().encode(pa.array(texts, pa.string()))
    assert got.to_pylist() == reference.encode([t or "" for t in texts], num_threads=1)
    back = piece_model().decode(got).to_pylist()
    assert back == [(t or "").replace("▁", " ") for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_any_text(texts):
    same(texts)


def test_spaces_pieces_and_unknown_characters():
    rng = random.Random(5)
    pieces = [reference.id_to_piece(i) for i in range(259, 32_000)]
    same(["".join(rng.choices("  abcdeéñß日<>0x\n\tthe▁", k=rng.randint(0, 60))) for _ in range(2_000)])
    same(["".join(rng.choices(pieces, k=rng.randint(1, 12))).replace("▁", " ") for _ in range(2_000)])
    same([" " * k + "a" + " " * (40 - k) for k in range(41)])


def test_memory_of_a_batch():
    """A batch of 6 MB of new words needs its ids and the temporaries of a small part of it."""
    rng = random.Random(11)
    parts = ["ka", "lo", "mi", "ter", "un", "ves", "dra", "pol", "en", "st"]
    column = pa.array([" ".join("".join(rng.choices(parts, k=3)) for _ in range(400)) for _ in range(2_000)])
    tracemalloc.start()
    try:
        piece_model().encode(column)
        assert tracemalloc.get_traced_memory()[1] < 80e6
    finally:
        tracemalloc.stop()


def test_decodes_lists_that_no_text_gives():
    mark = reference.piece_to_id("▁")
    lists = [[1, 2], [3 + 0xE6], [3 + 0xFF, mark], [mark, mark, 3 + 0xE6, 3 + 0x97], []]
    got = piece_model().decode(pa.array(lists, pa.list_(pa.int32()))).to_pylist()
    assert got == ["", "�", "� ", " �", ""]
    assert "⁇" in piece_model().decode(pa.array([[0]], pa.list_(pa.int32()))).to_pylist()[0]


def test_odd_rows_in_spark(spark):
    rows = odd_rows()
    docs = table(spark, rows)
    got = decode_documents(encode_documents(docs)).select("text", "ids", "decoded").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == reference.encode(r.text or "") and r.decoded == (r.text or "")
    assert encode_documents(table(spark, [])).collect() == []


def test_query_round_trips_every_document(spark):
    got = LLM_QUERIES["op2_sentencepiece"](spark, SF001)
    assert got.where("NOT round_trip").count() == 0
    assert codec_digest(table(spark, [(1, "▁ x")])).first().round_trip


def test_query_equals_the_library(spark):
    """All columns of the query over whole tables, ids by the public library."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in docs:
        ids = reference.encode(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), True)
    got = {r.doc_id: tuple(r)[1:] for r in LLM_QUERIES["op2_sentencepiece"](spark, SF001).collect()}
    assert got == want


def test_other_models_are_refused():
    with pytest.raises(RuntimeError):
        piece_model("/nonexistent.model")
