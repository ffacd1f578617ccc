from __future__ import annotations

import re

import pyarrow as pa
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SPACE, odd_rows, table
from tokenizers import models

from clickpulse.llm.queries import LLM_QUERIES
from clickpulse.llm.token_counts import LongestMatch, count_documents, vocabulary

begin, continuing = vocabulary()
_ids: dict[str, int] = {}
for entry in ["[UNK]", *sorted(begin), *("##" + c for c in sorted(continuing))]:
    _ids.setdefault(entry, len(_ids))
pieces = models.WordPiece(_ids, unk_token="[UNK]", max_input_chars_per_word=10**9)


def plain(text):
    found = [[t.value for t in pieces.tokenize(w)] for w in re.findall(f"[^{SPACE}]+", text or "")]
    return len(found), sum(map(len, found)), sum(f == ["[UNK]"] for f in found)


def greedy(word, begin, continuing):
    at, n = 0, 0
    while at < len(word):
        pool = continuing if at else begin
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pool), None)
        if end is None:
            return 0
        at, n = end, n + 1
    return n


def test_query_equals_the_word_piece_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in LLM_QUERIES["op7_token_counts"](spark, SF001).collect():
        assert (r.n_words, r.n_tokens, r.n_unknown) == plain(texts[r.doc_id])


def test_odd_rows(spark):
    got = count_documents(table(spark, odd_rows())).select("text", "counts.*").collect()
    assert len(got) == len(odd_rows())
    for r in got:
        assert (r.n_words, r.n_tokens, r.n_unknown) == plain(r.text)
    assert count_documents(table(spark, [])).collect() == []


@settings(max_examples=200, deadline=None)
@given(
    st.sets(st.text("abc", min_size=1, max_size=5), max_size=8),
    st.sets(st.text("abc", min_size=1, max_size=5), max_size=8),
    st.lists(st.text("abcd", min_size=1, max_size=14), min_size=1, max_size=6),
)
def test_any_vocabulary(begin, continuing, words):
    got = LongestMatch(begin, continuing).count(pa.array(words)).to_pylist()
    for word, counts in zip(words, got, strict=True):
        n = greedy(word, begin, continuing)
        assert counts == {"n_words": 1, "n_tokens": n or 1, "n_unknown": int(n == 0)}
