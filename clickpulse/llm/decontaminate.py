"""Benchmark decontamination by SimHash over item-sized windows.

A benchmark item's shingles are its five-word shingles, weighted by how often they
occur. A document is contaminated by an item if some window of as many words as
the item (the whole document, if it is shorter) has a weighted Jaccard similarity,
sum of minima over sum of maxima of the weights, of at least ``percent`` / 100.

Windows are fingerprinted by a 64-bit SimHash of their shingles numbered by occurrence within the
window: a shingle of weight w stands for w features of weight one, so no frequent shingle
outweighs the others, and the same features say how similar two windows are. The items'
fingerprints are indexed by eight blocks of eight bits, each item under every
value within two bits of its block: two fingerprints that differ in at most 23 bits
agree to two bits in some block, so no fingerprint within ``RADIUS`` is missed. The
pairs found are verified by their exact similarity. A window at the threshold
differs in 10 bits on average with a deviation of 3, whatever its weights. Windows without a shingle
of any item of their length have similarity 0 and are not fingerprinted.

The items travel to the tasks, never the documents: the benchmark is taken in
blocks of about ``BLOCK_BYTES`` of text, one pass over the documents each.

An item of one to four words has the whole sequence as its one shingle and needs
an equal window; items and documents without words match nothing; null texts
count as empty. Repeated items and rows give a result each. An empty benchmark
or table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import with_workers
from clickpulse.llm.words import SHINGLE_WORDS, chunks, gram_hashes, mix, shingle_hashes, word_hashes

PERCENT = 80
RADIUS = 23
BLOCK_BYTES = 8 << 20
#: Window starts handled at once.
_SLICE = 1 << 14

RESULT = "doc_id long, item_id long, similarity double, word_start long, words long, windows long"


def _bits(h: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each hash."""
    return np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").copy().view("<u8").ravel()


def _features(h: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """Hash of the ``occurrence``-th copy of each shingle; the first is the shingle's own."""
    more = mix(h + occurrence.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.where(occurrence > 1, more, h)


def _copies(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the copies of its shingle among the ``size`` places that end there, and that begin there."""
    n = len(h)
    order = np.argsort(h, kind="stable")
    group = np.cumsum(np.append(False, h[order][1:] != h[order][:-1])) if n else order
    key = group * (2 * n + size) + order  # grouped by shingle, in text order, groups far apart
    before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)
    before[order] = np.arange(n) - np.searchsorted(key, key - (size - 1)) + 1
    after[order] = np.searchsorted(key, key + size) - np.arange(n)
    return before, after


def window_sums(h: np.ndarray, size: int, repeats: bool = True) -> np.ndarray:
    """The bit sums of each window of ``size`` shingles, kept up from window to window."""
    before, after = _copies(h, size) if repeats else (None, None)
    if not repeats or before.max() == 1:  # every shingle is its own first copy in every window
        total = np.zeros((len(h) + 1, 64), np.int32)
        np.cumsum(_bits(h), axis=0, out=total[1:])
        return total[size:] - total[: len(total) - size]
    # The first window: the copies so far. Then the first place goes with its last copy, and the next comes with its own.
    sums = np.empty((len(h) - size + 1, 64), np.int32)
    sums[0] = _bits(_features(h[:size], before[:size])).sum(axis=0)
    if len(sums) > 1:
        comes = _bits(_features(h[size:], before[size:]))
        goes = _bits(_features(h[: len(h) - size], after[: len(h) - size]))
        np.cumsum(comes - goes, axis=0, out=sums[1:])
        sums[1:] += sums[0]
    return sums


_NEAR = [[v for v in range(256) if (v ^ x).bit_count() <= 2] for x in range(256)]


def _among(known: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes occur in a sorted array."""
    if not len(known):
        return np.zeros(len(h), bool)
    at = np.searchsorted(known, h)
    return known[np.minimum(at, len(known) - 1)] == h


class ItemIndex:
    """The items of one window length, by blocks of their fingerprints."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.ids = [i for i, _ in items]
        self.weights = [dict(zip(*(x.tolist() for x in np.unique(h, return_counts=True)), strict=True)) for _, h in items]
        self.known = np.unique(np.concatenate([h for _, h in items]))
        self.prints = _fingerprints(np.concatenate([window_sums(h, len(h)) for _, h in items]))
        octets = self.prints.view(np.uint8).reshape(-1, 8)
        self.lists: list[tuple[np.ndarray, np.ndarray]] = []
        for block in range(8):
            values = [v for x in octets[:, block] for v in _NEAR[x]]
            owner = np.repeat(np.arange(len(items)), [len(_NEAR[x]) for x in octets[:, block]])
            order = np.argsort(values, kind="stable")
            self.lists.append((np.searchsorted(np.asarray(values)[order], np.arange(257)), owner[order]))

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, item) positions of all pairs within the radius."""
        octets = prints.view(np.uint8).reshape(-1, 8)
        pairs = []
        for block, (starts, owner) in enumerate(self.lists):
            lo, hi = starts[octets[:, block]], starts[octets[:, block].astype(np.int64) + 1]
            count = hi - lo
            first = np.repeat(lo - (np.cumsum(count) - count), count)
            pairs.append(np.repeat(np.arange(len(prints)), count) * len(self.ids) + owner[first + np.arange(count.sum())])
        which, item = np.divmod(np.unique(np.concatenate(pairs)), len(self.ids))
        near = np.bitwise_count(prints[which] ^ self.prints[item]) <= RADIUS
        return which[near], item[near]


class Benchmark:
    """All items of a block, ready for scanning documents."""

    def __init__(self, items: list[tuple[int, str]], percent: int):
        self.percent = percent
        by_shingles: dict[int, list[tuple[int, np.ndarray]]] = {}
        self.short: dict[int, dict[int, list[int]]] = {}
        for lo, hi, raw, offsets in chunks(pa.array([t for _, t in items], pa.string())):
            words, rows, _, _ = word_hashes(raw, offsets)
            h, out = shingle_hashes(words, rows)
            for i in range(lo, hi):
                n = int(rows[i - lo + 1] - rows[i - lo])
                own = h[out[i - lo] : out[i - lo + 1]]
                if n >= SHINGLE_WORDS:
                    by_shingles.setdefault(len(own), []).append((items[i][0], own.copy()))
                elif n:
                    self.short.setdefault(n, {}).setdefault(int(own[0]), []).append(items[i][0])
        self.index = {m: ItemIndex(v) for m, v in sorted(by_shingles.items())}
        known = [h for v in by_shingles.values() for _, h in v]
        self.known = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)

    def scan(self, h: np.ndarray) -> Iterator[tuple[int, float, int, int]]:
        """``(item_id, similarity, first shingle, shingles)`` of each matching window of a document."""
        at = np.flatnonzero(_among(self.known, h))
        if not len(at):
            return
        repeats = len(np.unique(h)) < len(h)
        found = h[at]
        for m, index in self.index.items():
            # Windows without a shingle of the items of their length have similarity 0.
            own = at[_among(index.known, found)]
            if not len(own):
                continue
            size = min(m, len(h))
            near = np.zeros(len(h) + 1, np.int64)
            near[own + 1] = 1
            near = np.cumsum(near)
            starts = np.flatnonzero(near[size:] > near[: len(h) + 1 - size])
            for k in range(0, len(starts), _SLICE):
                yield from self._windows(h, index, starts[k : k + _SLICE], size, repeats)

    def _windows(self, h, index: ItemIndex, starts: np.ndarray, size: int, repeats: bool):
        # Neighbouring starts share one running sum.
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            a, b = int(run[0]), int(run[-1]) + size
            which, item = index.candidates(_fingerprints(window_sums(h[a:b], size, repeats)))
            for w, i in zip(which.tolist(), item.tolist(), strict=True):
                s = a + w
                score = self._similarity(h[s : s + size], index.weights[i])
                if score is not None:
                    yield index.ids[i], score, s, size

    def _similarity(self, window: np.ndarray, weights: dict[int, int]) -> float | None:
        values, counts = np.unique(window, return_counts=True)
        low = sum(min(c, weights.get(v, 0)) for v, c in zip(values.tolist(), counts.tolist(), strict=True))
        high = len(window) + sum(weights.values()) - low
        return low / high if 100 * low >= self.percent * high else None


def _scan(bench: Benchmark):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            out = []
            for lo, hi, raw, offsets in chunks(batch["text"]):
                words, rows, _, _ = word_hashes(raw, offsets)
                h, parts = shingle_hashes(words, rows)
                touched = _among(bench.known, h)
                touched = np.add.reduceat(np.append(touched, False), parts[:-1]) * (np.diff(parts) > 0)
                best: dict[tuple[int, int], list] = {}
                for r in np.flatnonzero((touched > 0) & (np.diff(rows) >= SHINGLE_WORDS)):
                    for item, score, start, size in bench.scan(h[parts[r] : parts[r + 1]]):
                        _keep(best, (int(r), item), score, start, size + SHINGLE_WORDS - 1)
                for k, known in bench.short.items():
                    g = gram_hashes(words, k)
                    for w in np.flatnonzero(np.isin(g, np.fromiter(known, np.uint64, len(known)))):
                        r = int(np.searchsorted(rows, w, "right")) - 1
                        if w + k <= rows[r + 1]:
                            for item in known[int(g[w])]:
                                _keep(best, (r, item), 1.0, int(w - rows[r]), k)
                out += [(ids[lo + r], item, *x) for (r, item), x in best.items()]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "item_id", "similarity", "word_start", "words", "windows"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def _keep(best: dict, key: tuple[int, int], score: float, start: int, words: int) -> None:
    """The most similar window of a pair, the earliest of equals, and the number of windows that match."""
    have = best.setdefault(key, [score, start, words, 0])
    have[3] += 1
    if score > have[0]:
        have[:3] = [score, start, words]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    percent: int = PERCENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document and item that matches: the best window's similarity and place, and how many match."""
    spark = with_workers(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(
        F.col(item_id_col).cast("bigint").alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = spark.createDataFrame([], RESULT)
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = [(r.item_id, r.text) for r in part.collect()]
        if rows:
            out = out.unionByName(texts.mapInArrow(_scan(Benchmark(rows, percent)), RESULT))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    bad = contaminated(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("_drop")).distinct()
    return docs.join(bad, docs[id_col] == bad["_drop"], "left_anti")
