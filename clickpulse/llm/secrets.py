"""Secret scan: fixed patterns, and formats learned by grammar inference.

Three kinds of credentials are found by fixed patterns (``assign``, ``access``,
``hex``, see ``base_spans``). They label the corpus: from the credentials of each
kind a prefix tree is built whose statistically compatible states are merged
(Hoeffding's bound) into a probabilistic automaton, the kind's format. One more
automaton is learned from ordinary long words. Then every other candidate, a maximal
run of 12 or more of ``[A-Za-z0-9+/_.=-]`` that touches no base span, is scored by all
automata. It is added as kind ``format`` if a format likes it about as well as its
own examples (``Automaton.typical``) and its score reaches ``MARGIN``.

Automata are learned from a bounded sample: per kind the ``EXAMPLES`` distinct
strings with the least hashes, over all documents. All documents and candidates are scanned.

Spans are in code points, ends exclusive. Null and empty texts have none. With no
credentials in the corpus nothing is learned and base spans are all. Repeated rows give
equal results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.automata import Automaton
from clickpulse.llm.common import with_workers
from clickpulse.llm.words import chunks

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ["assign", "access", "hex", "format"]

CANDIDATE_LEAST = 12
EXAMPLES = 300
MARGIN = 0.5
WORD = "word"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))
_TOKEN = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"))

SPANS = "array<struct<kind: string, start: long, end: long, score: double>>"


def _runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the maximal runs of ``mask`` inside a row that have at least ``least`` bytes."""
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(mask))]
    first[inner] = mask[inner]
    last[inner - 1] = mask[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = end - start >= least
    return start[long], end[long]


def _rows_with(data: bytes, words: tuple[bytes, ...], offsets: np.ndarray) -> list[int]:
    rows = set()
    for word in words:
        at = data.find(word)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, "right")) - 1
            rows.add(row)
            # On to the next row: the patterns then read this one whole.
            at = data.find(word, int(offsets[row + 1]))
    return sorted(rows)


class Chunk:
    """Base spans and other candidates of some texts, in bytes of the chunk."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets = raw, offsets
        found: list[tuple[int, int, int, int]] = []  # row, start, end, kind
        values: list[tuple[str, bytes]] = []
        # A row straddling word hits at most makes the patterns read a row in vain.
        for row in _rows_with(_LOWER[raw].tobytes(), KEYWORDS, offsets):
            text, at = self._row(row)
            for m in ASSIGN.finditer(text):
                if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                    found.append((row, at + m.start(), at + m.end(), 0))
                    values.append((KINDS[0], m[2].encode("latin-1")))
        for row in _rows_with(raw.tobytes(), (b"AKIA",), offsets):
            text, at = self._row(row)
            for m in ACCESS.finditer(text):
                if m.end() - m.start() >= ACCESS_LEAST:
                    found.append((row, at + m.start(), at + m.end(), 1))
                    values.append((KINDS[1], m[0].encode("latin-1")))
        start, end = _runs(_HEX[raw], offsets, HEX_LEAST)
        rows = np.searchsorted(offsets, start, "right") - 1
        for row, a, b in zip(rows.tolist(), start.tolist(), end.tolist(), strict=True):
            found.append((row, a, b, 2))
            values.append((KINDS[2], raw[a:b].tobytes()))
        self.base, self.values = found, values
        # Candidates that touch no base span.
        start, end = _runs(_TOKEN[raw], offsets, CANDIDATE_LEAST)
        if found:
            marks = np.zeros(len(raw) + 1, np.int64)
            for _, a, b, _ in found:
                marks[a] += 1
                marks[b] -= 1
            covered = np.concatenate([[0], np.cumsum(np.cumsum(marks[:-1]) > 0)])
            free = covered[end] == covered[start]
            start, end = start[free], end[free]
        self.start, self.end = start, end

    def _row(self, row: int) -> tuple[str, int]:
        """A row as one character per byte: the patterns are ASCII, so byte places are kept."""
        lo, hi = int(self.offsets[row]), int(self.offsets[row + 1])
        return self.raw[lo:hi].tobytes().decode("latin-1"), lo


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base spans of one text by plain regular expressions, as the definition reads: ``(kind, start, end)``."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= HEX_LEAST]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _examples(limit: int):
    """The ``limit`` distinct strings of each kind with the least hashes, of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, dict[bytes, int]] = {}

        def offer(kind: str, value: bytes) -> None:
            own = best.setdefault(kind, {})
            if value not in own:
                own[value] = int.from_bytes(hashlib.blake2b(value, digest_size=7).digest())
                if len(own) > 4 * limit:
                    trim(kind)

        def trim(kind: str) -> None:
            best[kind] = dict(sorted(best[kind].items(), key=lambda x: (x[1], x[0]))[:limit])

        for batch in batches:
            for _, _, raw, offsets in chunks(batch["text"]):
                part = Chunk(raw, offsets)
                for kind, value in part.values:
                    offer(kind, value)
                data = raw.tobytes()
                for value in {data[a:b] for a, b in zip(part.start.tolist(), part.end.tolist(), strict=True)}:
                    offer(WORD, value)
        for kind in list(best):
            trim(kind)
        rows = [(kind, value.decode("latin-1"), h) for kind, own in best.items() for value, h in own.items()]
        yield pa.record_batch(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))],
            names=["kind", "value", "h"],
        )

    return run


def learn_formats(docs: DataFrame, text_col: str = "text", examples: int = EXAMPLES) -> dict[str, Automaton]:
    """An automaton for each kind that occurs, and one for ordinary long words (``word``)."""
    with_workers(docs.sparkSession)
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    found = texts.mapInArrow(_examples(examples), "kind string, value string, h long").distinct()
    # The least of each of many parts, then of these: no task sees what all tasks have sent.
    for parts in (F.col("h") % 256, F.lit(0)):
        least = Window.partitionBy("kind", parts).orderBy("h", "value")
        found = found.withColumn("_k", F.row_number().over(least)).where(F.col("_k") <= examples).drop("_k")
    rows = found.collect()
    by_kind: dict[str, list[bytes]] = {}
    for r in sorted(rows, key=lambda r: (r.kind, r.h, r.value)):
        by_kind.setdefault(r.kind, []).append(r.value.encode("latin-1"))
    return {kind: Automaton(values) for kind, values in by_kind.items()}


def _spans(formats: dict[str, Automaton], margin: float):
    word = formats.get(WORD)
    kinds = [formats[k] for k in KINDS if k in formats]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[dict]] = []
            for lo, hi, raw, offsets in chunks(batch["text"]):
                part = Chunk(raw, offsets)
                likeness = np.zeros(len(part.base))
                if kinds and word is not None and part.base:
                    values = [v for _, v in part.values]
                    likeness = np.max([f.score(values) for f in kinds], axis=0) - word.score(values)
                found = [(*span, float(x)) for span, x in zip(part.base, likeness, strict=True)]
                if kinds and word is not None and len(part.start):
                    a, size = part.start, part.end - part.start
                    scores = [f.score_spans(raw, a, size) for f in kinds]
                    fits = np.any([s >= f.typical for s, f in zip(scores, kinds, strict=True)], axis=0)
                    gain = np.max(scores, axis=0) - word.score_spans(raw, a, size)
                    for k in np.flatnonzero(fits & (gain >= margin)).tolist():
                        row = int(np.searchsorted(offsets, a[k], "right")) - 1
                        found.append((row, int(a[k]), int(part.end[k]), 3, float(gain[k])))
                rows: list[list[dict]] = [[] for _ in range(hi - lo)]
                if found:
                    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                    for row, a, b, kind, score in sorted(found, key=lambda s: (s[0], s[1], s[3])):
                        zero = points[offsets[row]]
                        rows[row].append(
                            {"kind": KINDS[kind], "start": int(points[a] - zero), "end": int(points[b] - zero), "score": score}
                        )
                out += rows
            kind = pa.list_(
                pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
            )
            yield pa.record_batch([batch["doc_id"], pa.array(out, kind)], names=["doc_id", "spans"])

    return run


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", examples: int = EXAMPLES, margin: float = MARGIN
) -> DataFrame:
    """``doc_id, spans`` of every row: base spans and added ones, by start, then kind, with scores (0 if nothing is learned)."""
    formats = learn_formats(docs, text_col, examples)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_spans(formats, margin), f"doc_id long, spans {SPANS}")
