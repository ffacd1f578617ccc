from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from conftest import SF001, SF01
from oracle import duck, duck_rows, fingerprint, spark_rows

from clickpulse.llm.prefix_trie import digest_turns, prefix_trie, share_openings
from clickpulse.llm.queries import LLM_ORACLE, LLM_QUERIES, rebuilt_trie

SCHEMA = "conv_id long, turn long, role string, text string, place int, digest string, points int, j int, member int, n int"


def table(spark, rows):
    """``conversations`` with further columns whose names the operator also uses inside."""
    return spark.createDataFrame([(*r, 1, "d", 2, 3, 4, 5) for r in rows], SCHEMA)


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def conversations(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append((turn is not None, turn or 0, digest(role, text), (role, text)))
    return {c: [t[-1] for t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute(convs):
    """All nodes by listing all openings of all conversations."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(set)
    for opening in members:
        if opening:
            kids[opening[:-1]].add(opening)
    out = []
    for opening, own in members.items():
        below = [o for o in members if o[: len(opening)] == opening]
        ends = sorted(c for c in own if len(convs[c]) == len(opening))
        out.append(
            (
                min(own),
                len(opening),
                min(members[opening[:-1]]) if opening else None,
                len(own),
                len(kids[opening]),
                sum(not kids[o] for o in below),
                sum((len(members[o]) - 1) * len(o[-1][1]) for o in below if o),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_equals_sql(spark, sf):
    got = fingerprint(*spark_rows(LLM_QUERIES["op11_prefix_trie"](spark, sf)))
    assert got == fingerprint(*duck_rows(duck(sf), LLM_ORACLE["op11_prefix_trie"]))


def odd_conversations():
    rng = random.Random(3)
    rows = [
        (None, 0, "user", "no conversation"),
        (0, None, "user", "before the first"),
        (0, 0, "user", "hello"),
        (0, 1, None, None),
        (0, 1, "user", "tie"),
        (0, 1, "user", "tie"),
        (1, 0, "", ""),
        (1, 7, None, "é日本𝕏"),
        (2, 0, "us", "er:x"),
        (3, 0, "user", ":x"),
        (350, 0, "user", "base of it is absent"),
    ]
    for c in range(100, 140):
        for t in range(rng.choice([1, 2, 4, 5, 8, 9, 13])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"t{t}" if rng.random() < 0.9 else f"{c}"))
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(6)]
    rows += [(400, t, "user", f"long {t}") for t in range(-1500, 1500, 10)]
    return rows


def test_odd_rows(spark):
    rows = odd_conversations()
    random.Random(1).shuffle(rows)
    got = rebuilt_trie(table(spark, rows).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rebuilt(conversations(rows)))


@pytest.mark.parametrize("block", [1, 2, 7])
def test_blocks_of_any_length(spark, block):
    rows = odd_conversations()
    turns = digest_turns(table(spark, rows))
    got = prefix_trie(turns, turns.select("conv_id"), block).collect()
    assert sorted(map(tuple, got), key=str) == brute(conversations(rows))


def test_pieces_of_long_conversations(spark, monkeypatch):
    monkeypatch.setattr("clickpulse.llm.prefix_trie.TURNS_OF_A_PIECE", 3)
    monkeypatch.setattr("clickpulse.llm.prefix_trie.IDS_OF_A_PIECE", 7)
    rows = odd_conversations()
    got = rebuilt_trie(table(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rebuilt(conversations(rows)))


def test_conversations_without_turns_end_at_the_root(spark):
    turns = digest_turns(table(spark, [(5, 0, "user", "x")]))
    ids = spark.createDataFrame([(5,), (6,), (4,), (None,)], "conv_id long")
    got = prefix_trie(turns, ids).collect()
    assert sorted(map(tuple, got), key=str) == brute({5: [("user", "x")], 6: [], 4: []})
    silent = prefix_trie(turns.where("false"), ids).collect()
    assert sorted(map(tuple, silent), key=str) == brute({5: [], 6: [], 4: []})


def test_empty_table(spark):
    empty = table(spark, [])
    assert rebuilt_trie(empty).collect() == []
    only_null = table(spark, [(None, 1, "user", "x")])
    assert rebuilt_trie(only_null).collect() == []
    assert share_openings(digest_turns(empty), empty.select("conv_id")).collect() == []
