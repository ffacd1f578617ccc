"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 of ``DIMENSIONS`` places, drawn from
its code point. An n-gram's vector binds its letters' vectors, each rotated by its
place in the n-gram, by multiplication. A text's vector bundles (sums) the vectors of all
its n-grams; a language's prototype bundles those of its texts. A text gets the
language whose prototype has the greatest cosine with its vector.

Letters are the characters that Unicode counts as alphabetic, lower-cased; each
run of others counts as one space, and a space goes before and after each text.

Vectors of different n-grams are nearly orthogonal, so prototypes of any number of
languages over any alphabet have the same fixed size: that of all prototypes is
languages x ``DIMENSIONS`` numbers, one vector per task and language is summed.

A text without letters (null, empty, digits) gets ``und`` and score 0, as does every
text if nothing was learned. Rows without a language do not teach. Of equal cosines the
first language by name wins. Columns other than id, text and language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import with_workers
from clickpulse.llm.words import chunks, code_points

DIMENSIONS = 1024
GRAM = 3
SEED = 5
UNDETERMINED = "und"
#: Distinct n-gram vectors kept by a worker (1 kB each); beyond it they are made anew.
KEPT_GRAMS = 40_000
_SPACE = 32

_fold: np.ndarray | None = None


def _folding() -> np.ndarray:
    """Code point -> lower-cased letter, or a space for any other character."""
    global _fold
    if _fold is None:
        table = np.full(0x110000, _SPACE, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _fold = table
    return _fold


class GramVectors:
    """Vectors of n-grams, by the n-gram's packed code points (21 bits each)."""

    def __init__(self, dimensions: int, gram: int, seed: int):
        self.dimensions, self.gram, self.seed = dimensions, gram, seed
        self.letters: dict[int, np.ndarray] = {}
        self._clear()

    def _clear(self) -> None:
        self.row: dict[int, int] = {}
        self.vectors = np.zeros((1024, self.dimensions), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            rng = np.random.default_rng([self.seed, code])
            self.letters[code] = rng.integers(0, 2, self.dimensions).astype(np.int8) * 2 - 1
        return self.letters[code]

    def bound(self, key: int) -> np.ndarray:
        out = np.ones(self.dimensions, np.int8)
        for place in range(self.gram):
            code = (key >> (21 * place)) & 0x1FFFFF
            out = out * np.roll(self.letter(code), place)
        return out

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Their vectors, as floats."""
        if len(self.row) + len(keys) > max(KEPT_GRAMS, len(keys)):
            self._clear()
        at = np.empty(len(keys), np.int64)
        for i, key in enumerate(keys.tolist()):
            row = self.row.get(key)
            if row is None:
                row = self.row[key] = len(self.row)
                if row >= len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
                self.vectors[row] = self.bound(key)
            at[i] = row
        return self.vectors[at].astype(np.float32)


_cache: dict[tuple[int, int, int], GramVectors] = {}


def gram_vectors(dimensions: int = DIMENSIONS, gram: int = GRAM, seed: int = SEED) -> GramVectors:
    return _cache.setdefault((dimensions, gram, seed), GramVectors(dimensions, gram, seed))


def text_grams(raw: np.ndarray, offsets: np.ndarray, gram: int) -> tuple[np.ndarray, ...]:
    """``(distinct n-grams, which one each n-gram is, its row, rows' letter counts)``."""
    codes, rows = code_points(raw, offsets)
    folded = _folding()[codes]
    n = len(rows) - 1
    row = np.repeat(np.arange(n), np.diff(rows))
    letter = folded != _SPACE
    letters = np.bincount(row[letter], minlength=n)
    # One space before and after each text, and one for each run of others.
    first = np.ones(len(folded), bool)
    first[1:] = letter[:-1] | (row[1:] != row[:-1])
    keep = letter | first
    folded, row = folded[keep], row[keep]
    counts = np.bincount(row, minlength=n)
    padded = np.full(len(folded) + 2 * n, _SPACE, np.int64)
    padded[np.arange(len(folded)) + 2 * row + 1] = folded
    owner = np.repeat(np.arange(n), counts + 2)
    double = np.zeros(len(padded), bool)
    double[1:] = (padded[1:] == _SPACE) & (padded[:-1] == _SPACE) & (owner[1:] == owner[:-1])
    padded, owner = padded[~double], owner[~double]
    none = np.zeros(0, np.int64)
    if len(padded) < gram:
        return none, none, none, letters
    # Letters by small numbers, n-grams as numbers in that base.
    alphabet = np.flatnonzero(np.bincount(padded))
    number = np.zeros(int(alphabet[-1]) + 1, np.int64)
    number[alphabet] = np.arange(len(alphabet))
    small = number[padded]
    base = len(alphabet)
    key = np.zeros(len(padded) - gram + 1, np.int64)
    for place in range(gram - 1, -1, -1):
        key = key * base + small[gram - 1 - place : len(padded) - place]
    inside = owner[gram - 1 :] == owner[: len(key)]
    key, owner = key[inside], owner[: len(key)][inside]
    if base**gram <= 1 << 22:
        present = np.flatnonzero(np.bincount(key, minlength=1))
        position = np.zeros(int(present[-1]) + 1 if len(present) else 1, np.int64)
        position[present] = np.arange(len(present))
        inverse = position[key]
    else:
        present, inverse = np.unique(key, return_inverse=True)
    distinct = np.zeros(len(present), np.int64)
    for place in range(gram):
        distinct |= alphabet[present // base**place % base].astype(np.int64) << (21 * place)
    return distinct, inverse, owner, letters


def _bundles(lang_of: str, settings: tuple[int, int, int]):
    """One summed vector per language of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = gram_vectors(*settings)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch[lang_of].to_pylist(), object)
            for lo, hi, raw, offsets in chunks(batch["text"]):
                distinct, inverse, owner, _ = text_grams(raw, offsets, settings[1])
                if not len(distinct):
                    continue
                names, which = np.unique(langs[lo:hi].astype(str), return_inverse=True)
                count = np.bincount(which[owner] * len(distinct) + inverse, minlength=len(names) * len(distinct))
                bundle = count.reshape(len(names), -1).astype(np.float32) @ vectors.of(distinct)
                for name, vector in zip(names.tolist(), bundle.astype(np.float64), strict=True):
                    sums[name] = sums.get(name, 0) + vector
        names = list(sums)
        yield pa.record_batch(
            [pa.array(names, pa.string()), pa.array([sums[x] for x in names], pa.list_(pa.float64()))], names=["lang", "v"]
        )

    return run


def learn(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    dimensions: int = DIMENSIONS,
    gram: int = GRAM,
    seed: int = SEED,
) -> DataFrame:
    """``lang, prototype`` of each language of ``docs``, summed over all its texts."""
    if not 1 <= gram <= 3:
        raise ValueError("n-grams of one to three letters")
    with_workers(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    parts = rows.mapInArrow(_bundles("lang", (dimensions, gram, seed)), "lang string, v array<double>")
    places = parts.select("lang", F.posexplode("v").alias("place", "x")).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    return places.groupBy("lang").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "x"))), lambda p: p["x"]).alias("prototype")
    )


def _predict(names: list[str], prototypes: np.ndarray, settings: tuple[int, int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = gram_vectors(*settings)
        for batch in batches:
            n_rows = batch.num_rows
            best, score = np.full(n_rows, -1), np.zeros(n_rows)
            for lo, hi, raw, offsets in chunks(batch["text"]):
                distinct, inverse, owner, letters = text_grams(raw, offsets, settings[1])
                if not len(distinct) or not len(names):
                    continue
                profile = vectors.of(distinct)
                # A few texts at a time: their n-gram counts are a dense table.
                step = max(1, (4 << 20) // max(len(distinct), 1))
                cuts = np.searchsorted(owner, np.arange(0, hi - lo + step, step))
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    size = min(step, hi - lo - k * step)
                    if size <= 0:
                        break
                    flat = (owner[a:b] - k * step) * len(distinct) + inverse[a:b]
                    count = np.bincount(flat, minlength=size * len(distinct)).reshape(size, -1).astype(np.float32)
                    bundle = (count @ profile).astype(np.float64)
                    norm = np.linalg.norm(bundle, axis=1)
                    cosine = (bundle @ prototypes.T) / np.maximum(norm, 1e-300)[:, None]
                    at = slice(lo + k * step, lo + k * step + size)
                    best[at] = np.argmax(cosine, axis=1)
                    score[at] = np.clip(cosine.max(axis=1), 0, 1)
                none = letters == 0
                best[lo:hi][none] = -1
                score[lo:hi][none] = 0
            labels = [names[k] if k >= 0 else UNDETERMINED for k in best.tolist()]
            keep = [c for c in batch.schema.names if c != "text"]
            yield pa.record_batch(
                [*(batch[c] for c in keep), pa.array(labels, pa.string()), pa.array(score)],
                names=[*keep, "lang_pred", "score"],
            )

    return run


def predict(
    docs: DataFrame,
    prototypes: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    dimensions: int = DIMENSIONS,
    gram: int = GRAM,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row. The prototypes (languages x dimensions numbers) travel to the tasks."""
    with_workers(docs.sparkSession)
    learned = sorted(prototypes.collect(), key=lambda r: r["lang"])
    names = [r["lang"] for r in learned]
    matrix = np.array([r["prototype"] for r in learned], np.float64).reshape(len(names), dimensions)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_predict(names, matrix, (dimensions, gram, seed)), "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, teaches: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows where ``teaches`` holds and predict every row."""
    return predict(docs, learn(docs.where(teaches), text_col, lang_col), id_col, text_col)
