"""Token counts by a linear longest-match automaton.

A word (a maximal run outside ``[\\x20\\x09-\\x0D]``) is cut greedily: the longest
vocabulary entry that begins it, then the longest that continues, and so on. The
vocabulary is a model's: entries with the space mark begin words, the others
continue them, and single characters may begin one too. A word that cannot be cut
to its end is one unknown token, as usual for word pieces.

The automaton is a trie with failure links. When no entry goes on with the next
character, the link of a node leads to the node that the greedy cut would have
reached, and its count says how many entries it would have cut on the way. So each
character is read once and no piece is ever built: the length is the sum of counts.

Distinct words are counted once per worker. Null and empty texts have no words.
Words of any length are read whole. Every row is counted on its own; other
columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import with_workers
from clickpulse.llm.spans import SpanMemory
from clickpulse.llm.words import chunks, code_points, span_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BATCH_BYTES = 2 << 20
#: Code points that separate words.
SPACES = np.array([32, 9, 10, 11, 12, 13], np.uint32)


def vocabulary(path: str = MODEL) -> tuple[set[str], set[str]]:
    """``(entries that begin a word, entries that continue one)`` of a SentencePiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size()) if not special(i)]
    continuing = {p for p in pieces if MARK not in p}
    begin = {p[1:] for p in pieces if p.startswith(MARK) and MARK not in p[1:]} - {""}
    return begin | {p for p in continuing if len(p) == 1}, continuing


class LongestMatch:
    """Trie with failure links and counts of popped entries."""

    def __init__(self, begin: Iterable[str], continuing: Iterable[str]):
        begin, continuing = set(begin), set(continuing)
        alphabet = sorted(set("".join(begin)) | set("".join(continuing)))
        symbol = {c: k + 1 for k, c in enumerate(alphabet)}
        self.size = len(alphabet) + 1
        self.symbol_of = np.zeros(0x110000, np.int32)
        self.symbol_of[[ord(c) for c in alphabet]] = list(symbol.values())
        rng = np.random.default_rng(11)
        self.symbol_values = rng.integers(1, 2**63, self.size, dtype=np.uint64)

        # Node 0 begins a word, node 1 continues one.
        step: list[dict[int, int]] = [{}, {}]
        entry = [False, False]
        for top, words in ((0, begin), (1, continuing)):
            for word in sorted(words):
                node = top
                for c in word:
                    after = step[node].get(symbol[c])
                    if after is None:
                        after = step[node][symbol[c]] = len(step)
                        step.append({})
                        entry.append(False)
                    node = after
                entry[node] = True

        # Breadth first: the link of a node needs the links of shorter strings only.
        dead = -1
        link, pops = [dead] * len(step), [0] * len(step)
        level = [0, 1]
        while level:
            following = []
            for node in level:
                for c, after in step[node].items():
                    following.append(after)
                    if entry[after]:
                        link[after], pops[after] = 1, 1
                        continue
                    at, popped = link[node], pops[node]
                    while at != dead and c not in step[at]:
                        popped += pops[at]
                        at = link[at]
                    if at != dead:
                        link[after], pops[after] = step[at][c], popped
            level = following
        self.link, self.pops = np.array(link), np.array(pops)
        edges = sorted((node * self.size + c, after) for node, steps in enumerate(step) for c, after in steps.items())
        self.edge_keys = np.array([k for k, _ in edges], np.int64)
        self.edge_nodes = np.array([n for _, n in edges], np.int64)
        self.memory = SpanMemory(self.count_spans)

    def _next(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The node one symbol on, or -1."""
        if not len(self.edge_keys):
            return np.full(len(node), -1)
        key = node * self.size + symbol
        at = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
        return np.where(self.edge_keys[at] == key, self.edge_nodes[at], -1)

    def count_spans(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each word, 0 for one that cannot be cut; all words step together, a symbol at a time."""
        order = np.argsort(start - end, kind="stable")  # longest first: the words still running are a prefix
        start, length = start[order], (end - start)[order]
        node = np.zeros(len(start), np.int64)
        total = np.zeros(len(start), np.int64)
        live = np.ones(len(start), bool)
        running = np.searchsorted(-length, -np.arange(int(length.max(initial=0))))
        for k, n in enumerate(running.tolist()):
            at = np.flatnonzero(live[:n])
            c = symbols[start[at] + k].astype(np.int64)
            while len(at):
                after = self._next(node[at], c)
                moved = after >= 0
                node[at[moved]] = after[moved]
                at, c = at[~moved], c[~moved]
                at, c = self._fall(at, c, node, total, live)
        at = np.flatnonzero(live & (node != 1))
        while len(at):
            at, _ = self._fall(at, at, node, total, live)
            at = at[node[at] != 1]
        total[~live] = 0
        out = np.empty(len(total), np.int64)
        out[order] = total
        return np.ones(len(out), np.int64), out

    def _fall(self, at, c, node, total, live):
        """Follow the failure links of these words; those without one cannot be cut."""
        here = node[at]
        total[at] += self.pops[here]
        node[at] = self.link[here]
        lost = node[at] < 0
        live[at[lost]] = False
        return at[~lost], c[~lost]

    def count(self, column: pa.Array) -> pa.Array:
        """Structs of words, tokens and unknown words of each text."""
        words, tokens, unknown = [], [], []
        for _, _, raw, offsets in chunks(column, BATCH_BYTES):
            codes, rows = code_points(raw, offsets)
            inside = ~np.isin(codes, SPACES)
            row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
            border = np.ones(max(len(codes) - 1, 0), bool)
            border[:] = row[1:] != row[:-1]
            first, last = inside.copy(), inside.copy()
            first[1:] &= ~inside[:-1] | border
            last[:-1] &= ~inside[1:] | border
            start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
            symbols = self.symbol_of[codes]
            hashes = span_hashes(self.symbol_values[symbols], start, end)
            values, at, _ = self.memory(symbols, hashes, start, end)
            count = values[at].astype(np.int64)
            n = len(rows) - 1
            owner = row[start] if len(start) else np.zeros(0, np.int64)
            words.append(np.bincount(owner, minlength=n))
            tokens.append(np.bincount(owner, weights=np.maximum(count, 1), minlength=n).astype(np.int64))
            unknown.append(np.bincount(owner, weights=count == 0, minlength=n).astype(np.int64))
        empty = [np.zeros(0, np.int64)]
        parts = [pa.array(np.concatenate(x or empty).astype(np.int64)) for x in (words, tokens, unknown)]
        return pa.StructArray.from_arrays(parts, names=["n_words", "n_tokens", "n_unknown"])


_automata: dict[str, LongestMatch] = {}


def automaton(path: str = MODEL) -> LongestMatch:
    """The automaton of a model, built once per worker."""
    if path not in _automata:
        _automata[path] = LongestMatch(*vocabulary(path))
    return _automata[path]


def token_counts(text: Column, model: str = MODEL) -> Column:
    """Column of structs ``n_words, n_tokens, n_unknown``."""

    @F.arrow_udf("n_words long, n_tokens long, n_unknown long")
    def count_tokens(texts: pa.Array) -> pa.Array:
        return automaton(model).count(texts)

    return count_tokens(text.cast("string"))


def count_documents(docs: DataFrame, text_col: str = "text", counts_col: str = "counts", model: str = MODEL) -> DataFrame:
    """``docs`` with a struct column of counts."""
    with_workers(docs.sparkSession)
    return docs.withColumn(counts_col, token_counts(F.col(text_col), model))
