"""Word and shingle hashes of whole Arrow batches, in numpy.

Words are the maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` after
lower-casing A-Z. A shingle is five consecutive words; a text of one to four
words has its whole sequence as its only shingle, a text without words has none.
Hashes are 64 bits wide and depend on content alone, so they agree between
tasks, runs and machines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
#: Text bytes handled at once; numpy temporaries are a few dozen times as large.
CHUNK_BYTES = 1 << 18

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_MULT = _rng.integers(1, 2**63, SHINGLE_WORDS, dtype=np.uint64) | _U(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_VALUE = _BYTE[_LOWER]

_powers: dict[str, np.ndarray] = {}


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        table = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        table[0] = 1
        have = _powers[kind] = np.cumprod(table, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Content hash of each span of ``values`` (64-bit, one per symbol): a polynomial in an odd base."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _power("up", _BASE, n), out=total[1:])
    h = (total[end] - total[start]) * _power("down", _BASE_INV, n + 1)[start]
    return mix(h + (end - start).astype(np.uint64))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive rows of about ``limit`` bytes.

    A row is never split: a longer text makes a chunk of its own.
    """
    raw, offsets = text_buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def code_points(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unicode code points of UTF-8 bytes, and the row offsets counted in them."""
    codes = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=before[1:])
    return codes, before[offsets]


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, row offsets into the words, start byte, end byte)`` of every word of the rows."""
    n = len(raw)
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none
    word = ~_SPACE[raw]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    begins[inner] = word[inner]
    ends[inner - 1] = word[inner - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    h = span_hashes(_VALUE[raw], start, end)
    return h, np.searchsorted(start, offsets), start, end


def shingle_hashes(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, row offsets into the shingles)``, repeats kept, in text order."""
    k = SHINGLE_WORDS
    count = np.diff(rows)
    sizes = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    out = np.zeros(len(count) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    if len(words) >= k:
        h = words[: len(words) - k + 1] * _MULT[0]
        for i in range(1, k):
            h = h + words[i : len(words) - k + 1 + i] * _MULT[i]
        h = mix(h)
    else:
        h = np.zeros(0, np.uint64)
    # The shingle that starts at word w lies in one row when w is at most k words before the row's end.
    first = np.repeat(rows[:-1] - out[:-1], sizes) + np.arange(out[-1])
    long = np.repeat(count >= k, sizes)
    result = np.zeros(int(out[-1]), np.uint64)
    result[long] = h[first[long]]
    for r in np.flatnonzero((count > 0) & (count < k)):
        part = words[rows[r] : rows[r + 1]]
        result[out[r]] = mix((part * _MULT[: len(part)]).sum(dtype=np.uint64, keepdims=True) + _U(len(part)))[0]
    return result, out


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` (below five) words from each word on; equals the shingle of a text of just these words."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    h = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        h = h + words[i : len(words) - k + 1 + i] * _MULT[i]
    return mix(h)


def shingles(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words, rows, _, _ = word_hashes(raw, offsets)
    return shingle_hashes(words, rows)
