"""Results per distinct span of text, remembered over the batches of a Python worker."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Distinct spans remembered by a worker (about 50 bytes each); beyond it the memory starts afresh.
REMEMBERED = 1_000_000


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all items of the slices ``[start, start + length)``, one after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)


class SpanMemory:
    """Lists of int32 by a span's 64-bit content hash."""

    def __init__(self, compute: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]):
        self.compute = compute
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.values = np.zeros(0, np.int32)

    def __call__(
        self, symbols: np.ndarray, hashes: np.ndarray, start: np.ndarray, end: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(values, first, length)``: the list of span i is ``values[first[i] : first[i] + length[i]]``.

        Spans not seen before go through ``compute`` all at once, as
        ``(symbols, start, end)`` of the distinct new ones; it returns list
        lengths and the lists one after the other.
        """
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self._clear()
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            lengths, values = self.compute(symbols, start[first[new]], end[first[new]])
            starts = len(self.values) + np.cumsum(lengths) - lengths
            self.keys = np.insert(self.keys, at[new], distinct[new])
            self.starts = np.insert(self.starts, at[new], starts)
            self.lengths = np.insert(self.lengths, at[new], lengths)
            self.values = np.concatenate([self.values, values.astype(np.int32)])
            at = np.searchsorted(self.keys, distinct)
        return self.values, self.starts[at][inverse], self.lengths[at][inverse]
