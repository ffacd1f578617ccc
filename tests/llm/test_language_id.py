from __future__ import annotations

import zlib

import numpy as np
from conftest import SF01
from llm_data import odd_rows, table
from pyspark.sql import functions as F

from clickpulse.llm import language_id as L
from clickpulse.llm.queries import LLM_QUERIES


def grams(text):
    out, last = [" "], " "
    for c in text or "":
        low = c.lower()
        c = (low if len(low) == 1 else c) if c.isalpha() else " "
        if not (c == " " and last == " "):
            out.append(c)
        last = c
    if last != " ":
        out.append(" ")
    return ["".join(out[i : i + 3]) for i in range(len(out) - 2)]


def vector(text):
    v = L.gram_vectors()
    total = np.zeros(L.DIMENSIONS)
    for g in grams(text):
        total += np.prod([np.roll(v.letter(ord(c)), 2 - k) for k, c in enumerate(g)], axis=0)
    return total


def test_held_out_accuracy(spark):
    got = LLM_QUERIES["op4_language_id"](spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet"), "doc_id")
    rows = got.select("doc_id", "held_out", "lang", "lang_pred", "score").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_equals_vectors_built_one_by_one(spark):
    texts = [(1, "Über den Wäldern, 12 Mal!", "de"), (2, "der Wald", "de"), (3, "el bosque y el río", "es"), (4, "los ríos", "es")]
    docs = table(spark, texts)
    learned = {r["lang"]: np.array(r["prototype"]) for r in L.learn(docs).collect()}
    for lang in ("de", "es"):
        assert np.allclose(learned[lang], sum(vector(t) for _, t, x in texts if x == lang))
    got = {r.doc_id: r for r in L.predict(docs, L.learn(docs)).collect()}
    for d, text, _ in texts:
        v = vector(text)
        cosines = {x: p @ v / np.linalg.norm(p) / np.linalg.norm(v) for x, p in learned.items()}
        best = max(cosines, key=cosines.get)
        assert got[d].lang_pred == best and abs(got[d].score - cosines[best]) < 1e-5


def test_odd_rows(spark):
    docs = table(spark, odd_rows())
    got = L.identify(docs, F.lit(True)).collect()
    assert len(got) == len(odd_rows())
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[d].lang_pred == "und" and by_id[d].score == 0 for d in (1, 2, 3, 12))
    assert by_id[11].lang_pred == "xx" and {r.lang_pred for r in got} <= {"en", "xx", "und"}


def test_nothing_learned_and_empty_table(spark):
    docs = table(spark, odd_rows(10))
    assert {(r.lang_pred, r.score) for r in L.identify(docs, F.lit(False)).collect()} == {("und", 0.0)}
    assert L.identify(table(spark, []), F.lit(True)).collect() == []


def test_many_letters_take_the_other_way():
    # Over 161 different letters in one chunk: n-grams are told apart by sorting.
    text = "".join(chr(0x4E00 + k) for k in range(400))
    raw = np.frombuffer(text.encode(), np.uint8)
    distinct, inverse, owner, letters = L.text_grams(raw, np.array([0, len(raw)]), 3)
    assert len(distinct) == 400 and letters.tolist() == [400] and len(inverse) == 400
    codes = [ord(c) for c in " " + text + " "]
    want = [codes[i] << 42 | codes[i + 1] << 21 | codes[i + 2] for i in range(400)]
    assert distinct[inverse].tolist() == want
