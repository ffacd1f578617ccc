"""Small tables and plain re-statements of the definitions, for the tests of the training-data operators."""

from __future__ import annotations

import re
from collections import Counter

SPACE = " \t\n\x0b\x0c\r"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, digest string, `_rank` int, token long,"
    " class string, comp int, tag string, ranges string, score string, shard string, `_drop` int, `_keep` int, spans int"
)


def table(spark, rows):
    """``documents`` with further columns whose names the operators also use inside."""
    full = []
    for r in rows:
        doc_id, text, *rest = r
        lang, source = (*rest, None, None)[:2]
        full.append((doc_id, text, lang, source, None, "d", 1, 2, "c", 3, "t", "r", "s", "x", 4, 5, 6))
    return spark.createDataFrame(full, SCHEMA)


def odd_rows(long_words: int = 30_000):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, control characters and other scripts."""
    prose = "the quick brown fox jumps over the lazy dog and runs away from the old grey wolf"
    long = " ".join(f"w{k % 977}x{k % 31}" for k in range(long_words))
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n\x0b\x0c\r ", "en", "a"),
        (4, prose, "en", "a"),
        (5, prose + " ", "en", "a"),
        (5, prose + " ", "en", "a"),
        (6, prose.upper(), "en", None),
        (7, "one two", "en", "b"),
        (8, "One  two", None, "b"),
        (9, long, "en", "b"),
        (10, long + " end", "en", "b"),
        (11, "日本語 ☃ 𝕏 naïve Œuvre İstanbul", "xx", "c"),
        (12, "12345 !!! ---", "en", "c"),
        (13, "x" * 5_000, "en", "c"),
        (14, "line one\nline one\nline one\x00 nul \x7f", "en", "c"),
        (None, prose, "en", "a"),
        (None, "without an id", None, None),
    ]


def words(text):
    return re.findall(f"[^{SPACE}]+", (text or "").translate(_LOWER))


def shingle_list(text_words):
    w = text_words
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def components(sets: dict) -> dict:
    """Smallest id reachable over pairs of sets with Jaccard similarity of 0.8 or more, by comparing all pairs."""
    ids = sorted(sets)
    parent = {d: d for d in ids}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    p, q = root(a), root(b)
                    parent[max(p, q)] = min(p, q)
    return {d: root(d) for d in ids}


def leaks(docs: dict, items: dict) -> dict:
    """``(doc, item) -> (best similarity, first best window, matching windows)`` by trying all windows."""
    out = {}
    for d, text in docs.items():
        w = words(text)
        for i, item in items.items():
            v = words(item)
            if not v or not w:
                continue
            y, size = Counter(shingle_list(v)), min(len(v), len(w))
            if len(v) < 5:
                if len(w) < len(v):
                    continue
                windows = [(tuple(w[k : k + len(v)]),) for k in range(len(w) - len(v) + 1)]
            elif len(w) < 5:
                continue
            elif y.keys().isdisjoint(shingle_list(w)):
                continue  # every window has similarity 0
            else:
                windows = [shingle_list(w[k : k + size]) for k in range(len(w) - size + 1)]
            for k, window in enumerate(windows):
                x = Counter(window)
                low = sum((x & y).values())
                high = sum((x | y).values())
                if 100 * low >= 80 * high:
                    best = out.setdefault((d, i), [low / high, k, 0])
                    best[2] += 1
                    if low / high > best[0]:
                        best[:2] = [low / high, k]
    return {k: tuple(v) for k, v in out.items()}
