from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import odd_rows, table

from clickpulse.llm import suffix_dedup as S
from clickpulse.llm.queries import LLM_QUERIES
from clickpulse.llm.sais import permuted_lcp, suffix_array


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        flips = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), len(flips) // 2, hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.binary(max_size=60), st.text("ab", max_size=60).map(str.encode), st.text("abc", max_size=6).map(lambda s: s.encode() * 9)))
def test_suffix_array_and_prefixes(data):
    text = np.append(np.minimum(np.frombuffer(data, np.uint8), 253) + 1, 0).astype(np.uint8)
    sa = suffix_array(text, 256)
    assert sa.tolist() == sorted(range(len(text)), key=lambda i: bytes(text[i:]))
    shared = permuted_lcp(text, sa)
    for a, b in zip(sa, sa[1:], strict=False):
        k = 0
        while text[a + k] == text[b + k]:
            k += 1
        assert shared[b] == k


def test_query_equals_all_strings(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip((r.doc_id for r in rows), brute(r.text for r in rows), strict=True))
    got = {r.doc_id: tuple(r)[1:] for r in LLM_QUERIES["op9_suffix_array_dedup"](spark, SF001).collect()}
    assert got == want


def hard_texts():
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    line, passage = letters(150), letters(700)
    out = [None, "", "z" * 199, "z" * 200, "y" * 1_000, "ab" * 400, letters(199)]
    out += [letters(rng.randrange(300)) + line + letters(rng.randrange(300)) for _ in range(40)]
    for _ in range(40):
        a = rng.randrange(500)
        out.append(letters(rng.randrange(200)) + passage[a : a + rng.randrange(150, 400)] + letters(rng.randrange(200)))
    own = letters(230)
    out += [own + letters(10) + own, passage, passage, passage + "!", letters(50) + "y" * 260]
    return out


@pytest.mark.parametrize("crowd", [S.CROWD, 3], ids=["shards", "crowded anchors"])
def test_passages_lines_runs_and_copies(spark, monkeypatch, crowd):
    monkeypatch.setattr(S, "CROWD", crowd)
    monkeypatch.setattr(S, "SHARD_BYTES", 5_000)
    texts = hard_texts()
    got = S.remove_repeats(table(spark, enumerate(texts)).repartition(6)).collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got}
    assert [found[k] for k in range(len(texts))] == brute(texts)


def test_odd_rows_and_empty_table(spark):
    rows = odd_rows(3_000)
    got = S.remove_repeats(table(spark, rows)).collect()
    want = brute(t for _, t, *_ in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in got) == sorted(
        (str(d), a, b) for (d, *_), (a, b, *_) in zip(rows, want, strict=True)
    )
    assert S.remove_repeats(table(spark, [])).collect() == []


def test_texts_are_told_apart_by_content(spark):
    """Ids that are null or repeat, and texts of one length and one crc32: only what repeats goes."""
    rng = random.Random(11)
    passage = "".join(rng.choices("abcdefgh", k=400))
    first = passage + "".join(rng.choices("abcdefgh", k=112))
    other = forged(first, "".join(rng.choices("stuvwxyz", k=508)))
    assert zlib.crc32(first.encode()) == zlib.crc32(other) and len(other) == 512
    texts = [first, other.decode("ascii"), passage + "!"]
    for ids in ([None, None, 1], [7, 7, 7]):
        rows = list(zip(ids, texts, strict=True))
        got = S.remove_repeats(table(spark, rows).coalesce(1)).collect()
        want = brute(t for _, t in rows)
        assert sorted((r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got) == sorted(want)


def forged(like: str, start: str) -> bytes:
    """``start`` and seven-bit characters such that the crc32 is that of ``like``."""
    want = zlib.crc32(like.encode())
    rng = random.Random(1)
    while True:
        head = start[:-8] + "".join(rng.choices("stuvwxyz", k=8))
        for _ in range(64):
            body = head[:-4] + "".join(rng.choices("stuvwxyz", k=4))
            tail = crc_tail(zlib.crc32(body.encode()), want)
            if all(b < 128 and b >= 32 for b in tail):
                return body.encode() + tail


def crc_tail(now: int, want: int) -> bytes:
    """The four bytes that take the crc32 from ``now`` to ``want``."""
    steps = []
    for i in range(256):
        c = i
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        steps.append(c)
    back = {c >> 24: i for i, c in enumerate(steps)}
    state, goal = now ^ 0xFFFFFFFF, want ^ 0xFFFFFFFF
    picks = []
    for _ in range(4):
        i = back[goal >> 24]
        picks.append(i)
        goal = ((goal ^ steps[i]) << 8) & 0xFFFFFFFF
    out = bytearray()
    for i in reversed(picks):
        out.append((state ^ i) & 0xFF)
        state = (state >> 8) ^ steps[i]
    return bytes(out)


@pytest.mark.parametrize("bits", [8, 10, 24])
def test_anchors_do_not_depend_on_the_size_of_what_is_scanned(monkeypatch, bits):
    monkeypatch.setattr(S, "PLACE_BITS", bits)
    rng = np.random.default_rng(3)
    one = rng.integers(97, 101, 700).astype(np.uint8)
    around = [rng.integers(97, 101, n).astype(np.uint8) for n in (0, 300, 5_000, 100_000)]
    seen = set()
    for raw in around:
        whole = np.concatenate([raw, one])
        _, anchor, a, b, place = S.fragments(whole, np.array([0, len(raw), len(whole)]), S.Prefixes(whole, 0))
        own = a >= len(raw)
        seen.add(tuple(zip(anchor[own], a[own] - len(raw), b[own] - len(raw), place[own] - len(raw), strict=True)))
    assert len(seen) == 1


def test_rows_that_repeat_id_and_text(spark):
    text = "".join(random.Random(5).choices("abcdefgh", k=500))
    got = S.remove_repeats(table(spark, [(None, text)] * 300 + [(1, text[:150])])).collect()
    assert [r.n_removed for r in got if r.doc_id is None] == [500] * 300 and [r.n_removed for r in got if r.doc_id == 1] == [0]
