"""SentencePiece encoding and decoding by suffix-array matching.

The ids are those of the model's own BPE: start from single characters and merge
the neighbours whose joint piece scores best, leftmost first, until none is left.
Here they are found without merging. A batch's text falls into spans that no piece
crosses; its distinct spans are concatenated and indexed by a suffix array (sorted
as deep as the longest piece); every piece is binary-searched for its range of
occurrences; each occurrence is an edge from its first to its last character. Edges
are sorted by the position at which they end and relaxed in that order: a position
takes the piece whose predecessor, the piece already taken where it starts, would
stay unmerged next to it. Every prefix of a BPE result is the BPE result of
its own text, and a sequence is one exactly if all neighbours are, so one
piece fits at each position.

Supported are BPE models with byte fallback, identity normalisation and a dummy
prefix, whose pieces hold the space mark at their start or alone; others raise
``ValueError``. Runs of spaces take the model's run pieces at the end, as these score
lowest. Characters outside the vocabulary become their UTF-8 bytes. Decoding
gives the text back, except that U+2581, the space mark itself, becomes a space.

Null and empty texts give an empty list and decode to the empty text. Special
tokens' names in a text are ordinary text. Rows are independent, so ties, repeated
rows and empty tables need no rule; all other columns are kept as they are.
"""

from __future__ import annotations

import heapq
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import with_workers
from clickpulse.llm.spans import SpanMemory, gather
from clickpulse.llm.words import chunks, code_points, span_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = 0x2581
#: Text bytes taken at once, which no result depends on. A worker keeps what its largest temporaries took,
#: here about 100 bytes for each of these, on top of the model's 90 MB and the remembered spans.
BATCH_BYTES = 1 << 19
#: Ids decoded at once.
BATCH_IDS = 1 << 20
_NONE = np.int64(1 << 40)


class PieceModel:
    """The vocabulary, renumbered by merge order: single characters first, then pieces from best to lowest score."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        skip = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)
        pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in range(model.vocab_size()) if not skip(i)}
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        mark = chr(MARK)
        probe = f"  a{mark} b\n"
        if (
            len(set(self.byte_ids.tolist())) < 256
            or any(mark in p[1:] and p.strip(mark) for p in pieces)
            or any(c not in pieces for p in pieces for c in p)
            or model.decode(model.encode(probe)) != probe.replace(mark, " ")
        ):
            raise ValueError(f"{path}: not a BPE model with byte fallback, dummy prefix and leading space marks")
        self.runs = {p: i for p, (i, _) in pieces.items() if p.strip(mark) == ""}
        self.run_scores = {p: pieces[p][1] for p in self.runs}
        text = sorted((p for p in pieces if len(p) == 1), key=lambda p: pieces[p][0])
        merged = sorted((p for p in pieces if len(p) > 1 and p not in self.runs), key=lambda p: -pieces[p][1])
        scores = [pieces[p][1] for p in merged]
        lowest = max((s for p, s in self.run_scores.items() if len(p) > 1), default=-np.inf)
        if len(set(scores)) < len(scores) or (scores and scores[-1] <= lowest):
            raise ValueError(f"{path}: pieces with one score")
        order = text + merged
        number = {p: k for k, p in enumerate(order)}
        self.leaves = len(text)
        self.ids = np.array([pieces[p][0] for p in order], np.int32)
        self.mark = number[mark]

        # Characters as small numbers; 0 stands for any other character.
        symbol = {c: k + 1 for k, c in enumerate(sorted(text))}
        self.symbol_of = np.zeros(0x110000, np.int32)
        self.symbol_of[[ord(c) for c in symbol]] = list(symbol.values())
        self.size = len(symbol) + 1
        self.mark_symbol = symbol[mark]
        self.longest = max(map(len, order))

        # Which characters some piece holds next to each other.
        self.joins = np.zeros(self.size * self.size, bool)
        for p in merged:
            for a, b in zip(p, p[1:], strict=False):
                self.joins[symbol[a] * self.size + symbol[b]] = True

        # All splits of a piece in two, and the one that the merges take.
        pairs: dict[tuple[int, int], int] = {}
        for p in merged:
            for k in range(1, len(p)):
                a, b = number.get(p[:k]), number.get(p[k:])
                if a is not None and b is not None:
                    pairs[a, b] = number[p]
        n = len(order)
        self.left, self.right = np.arange(n), np.arange(n)
        whole = np.ones(n, bool)
        for p in merged:
            split = self._last_split([number[c] for c in p], pairs)
            k = number[p]
            if split is None:
                whole[k] = False  # the merges never make this piece
            else:
                self.left[k], self.right[k] = split
        keys = np.array([a * n + b for a, b in pairs], np.int64)
        by = np.argsort(keys)
        self.pair_keys, self.pair_values = keys[by], np.array(list(pairs.values()), np.int64)[by]
        self.n = n
        usable = np.flatnonzero(whole)
        self.piece_numbers = usable
        self.piece_lengths = np.array([len(order[k]) for k in usable])
        self.piece_symbols = np.zeros((len(usable), self.longest), np.int32)
        for row, k in enumerate(usable):
            self.piece_symbols[row, : len(order[k])] = [symbol[c] for c in order[k]]
        # Pieces as ranges of packed keys: the free places hold the least and the greatest symbols.
        self.bits = self.size.bit_length()
        self.per_key = 62 // self.bits
        head = self.piece_symbols[:, : self.per_key].astype(np.int64)
        fill = np.arange(head.shape[1]) >= self.piece_lengths[:, None]
        shifts = (self.per_key - 1 - np.arange(head.shape[1])) * self.bits
        self.piece_keys = (head << shifts).sum(axis=1)
        self.piece_keys_end = (np.where(fill, (1 << self.bits) - 1, head) << shifts).sum(axis=1)
        self._run_memory: dict[int, np.ndarray] = {}
        rng = np.random.default_rng(7)
        self.symbol_values = rng.integers(1, 2**63, self.size, dtype=np.uint64)
        self.memory = SpanMemory(self.encode_spans)
        # id -> bytes, for decoding
        names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else p.replace(mark, " ").encode()
            for i, p in enumerate(names)
        ]
        self.bytes_of[model.unk_id()] = " \u2047 ".encode()
        self.byte_starts = np.cumsum([0, *map(len, self.bytes_of)])
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    @staticmethod
    def _last_split(parts: list[int], pairs: dict[tuple[int, int], int]) -> tuple[int, int] | None:
        """The two parts that the merges join last, or None if they end with several."""
        while len(parts) > 2:
            best = min(((pairs.get(x, 1 << 40), k) for k, x in enumerate(zip(parts, parts[1:], strict=False))), default=None)
            if best is None or best[0] == 1 << 40:
                return None
            k = best[1]
            parts[k : k + 2] = [best[0]]
        return (parts[0], parts[1]) if len(parts) == 2 and tuple(parts) in pairs else None

    def stays(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the merges leave these two pieces side by side.

        The last merges are undone one by one, on whichever side they came later;
        at each step the merge across the border must not have come first.
        """
        a, b = left.astype(np.int64), right.astype(np.int64)
        limit = np.full(len(a), _NONE)
        out = np.zeros(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            key = a * self.n + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            across = np.where(self.pair_keys[at] == key, self.pair_values[at], _NONE)
            done = across < limit
            on_left = a > b
            limit = np.where(on_left, a, b + 1)
            a2 = np.where(on_left, self.right[a], a)
            b2 = np.where(on_left, b, self.left[b])
            # Both sides are single characters: nothing is left to undo.
            end = np.where(on_left, a2 == a, b2 == b)
            out[live[end & ~done]] = True
            go = ~done & ~end
            live, a, b, limit = live[go], a2[go], b2[go], limit[go]
        return out

    def packed(self, text: np.ndarray) -> np.ndarray:
        """The first ``per_key`` symbols of every suffix as one number."""
        padded = np.concatenate([text, np.zeros(self.per_key, text.dtype)]).astype(np.int64)
        key = np.zeros(len(text), np.int64)
        for k in range(self.per_key):
            key = (key << self.bits) | padded[k : k + len(text)]
        return key

    def suffix_array(self, key: np.ndarray) -> np.ndarray:
        """Suffixes in the order of their first ``longest`` symbols, by doubling the sorted depth."""
        depth = self.per_key
        order = np.argsort(key)
        while depth < self.longest:
            rank = np.zeros(len(key), np.int64)
            rank[order[1:]] = np.cumsum(np.diff(key[order]) != 0)
            later = np.zeros(len(key), np.int64)
            later[:-depth] = rank[depth:] + 1
            key = rank * (len(key) + 2) + later
            order = np.argsort(key)
            depth *= 2
        return order

    def occurrences(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(position, row of the piece)`` of every occurrence of every piece: a range of the suffix array each."""
        key = self.packed(text)
        order = self.suffix_array(key)
        sorted_key = key[order]
        padded = np.concatenate([text, np.zeros(self.longest, text.dtype)])
        columns = np.arange(self.longest)
        within = columns < self.piece_lengths[:, None]
        # Ranges by the first symbols; whole pieces of up to per_key symbols are done with that.
        low = np.searchsorted(sorted_key, self.piece_keys)
        high = np.searchsorted(sorted_key, self.piece_keys_end, "right")
        long = np.flatnonzero((self.piece_lengths > self.per_key) & (low < high))

        def bound(after: bool) -> np.ndarray:
            lo, hi = low[long], high[long]
            while (open_ := lo < hi).any():
                at = np.flatnonzero(open_)
                rows = long[at]
                mid = (lo[at] + hi[at]) // 2
                diff = padded[order[mid][:, None] + columns] - self.piece_symbols[rows]
                diff[~within[rows]] = 0
                sign = diff[np.arange(len(rows)), np.argmax(diff != 0, axis=1)]
                lower = sign <= 0 if after else sign < 0
                lo[at[lower]] = mid[lower] + 1
                hi[at[~lower]] = mid[~lower]
            return lo

        low[long], high[long] = bound(False), bound(True)
        count = high - low
        return order[gather(low, count)], np.repeat(np.arange(len(count)), count)

    def encode_spans(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of each span (no other characters inside, at most one space mark at its start)."""
        length = end - start
        first = np.cumsum(length + 1) - (length + 1)  # a 0 after each span, which no piece holds
        text = np.zeros(int((length + 1).sum()), np.int32)
        text[gather(first, length)] = symbols[gather(start, length)]
        at, piece = self.occurrences(text)
        # Edges by the position, within their span, at which they end.
        offset = np.arange(len(text)) - np.repeat(first, length + 1)
        width = self.piece_lengths[piece]
        stop = offset[at] + width
        by = np.argsort(stop, kind="stable")
        at, piece, width, stop = at[by], piece[by], width[by], stop[by]
        number = self.piece_numbers[piece]
        taken = np.full(len(text) + 1, -1, np.int64)  # the piece that ends before a position of the text
        steps = np.zeros(len(text) + 1, np.int64)
        cuts = np.searchsorted(stop, np.arange(1, int(length.max(initial=0)) + 2))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            a, n, w = at[lo:hi], number[lo:hi], width[lo:hi]
            before = taken[a]
            inner = offset[a] > 0
            good = ~inner
            good[inner] = self.stays(before[inner], n[inner])
            to = a[good] + w[good]
            taken[to] = n[good]
            steps[to] = w[good]
        # Walk back from the ends, all spans at once.
        spots = first + length
        back, owner = [], []
        who = np.arange(len(first))
        while len(spots):
            back.append(taken[spots])
            owner.append(who)
            spots = spots - steps[spots]
            more = spots > first[who]
            spots, who = spots[more], who[more]
        if not back:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        depth = np.repeat(np.arange(len(back)), [len(x) for x in back])
        owner, back = np.concatenate(owner), np.concatenate(back)
        sort = np.lexsort((-depth, owner))
        return np.bincount(owner, minlength=len(first)).astype(np.int64), back[sort]

    def run_ids(self, k: int) -> np.ndarray:
        """Ids of k space marks in a row: best score first, then leftmost."""
        if k not in self._run_memory:
            mark = chr(MARK)
            size = [1] * k
            after, before = list(range(1, k + 1)), list(range(-1, k - 1))
            heap: list[tuple[float, int, int, int]] = []

            def offer(a: int, b: int) -> None:
                p = mark * (size[a] + size[b]) if a >= 0 and b < k else ""
                if len(p) <= self.longest_run and p in self.runs:
                    heapq.heappush(heap, (-self.run_scores[p], a, b, len(p)))

            for x in range(k - 1):
                offer(x, x + 1)
            while heap:
                _, a, b, total = heapq.heappop(heap)
                if size[a] == 0 or size[b] == 0 or size[a] + size[b] != total or after[a] != b:
                    continue
                size[a], size[b] = total, 0
                after[a] = after[b]
                if after[b] < k:
                    before[after[b]] = a
                offer(before[a], a)
                offer(a, after[a])
            found = np.array([self.runs[mark * s] for s in size if s], np.int32)
            if len(self._run_memory) > 4096:
                self._run_memory.clear()
            self._run_memory[k] = found
        return self._run_memory[k]

    @property
    def longest_run(self) -> int:
        return max(map(len, self.runs))

    def encode(self, column: pa.Array) -> pa.Array:
        """Lists of ids of a string column."""
        lists = [self._encode_rows(raw, offsets) for _, _, raw, offsets in chunks(column, BATCH_BYTES)]
        values = np.concatenate([v for v, _ in lists]) if lists else np.zeros(0, np.int32)
        sizes = np.concatenate([s for _, s in lists]) if lists else np.zeros(0, np.int64)
        offsets = np.zeros(len(sizes) + 1, np.int32)
        np.cumsum(sizes, out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))

    def _encode_rows(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes, rows = code_points(raw, offsets)
        # A space mark goes before each text that is not empty; spaces become marks.
        full = np.diff(rows) > 0
        shift = np.cumsum(full)
        text = np.empty(len(codes) + int(shift[-1] if len(shift) else 0), np.uint32)
        text[np.arange(len(codes)) + np.repeat(shift, np.diff(rows))] = np.where(codes == 32, MARK, codes)
        rows = rows + np.concatenate([[0], shift])
        text[rows[:-1][full]] = MARK
        if not len(text):
            return np.zeros(0, np.int32), np.zeros(len(rows) - 1, np.int64)
        symbols = self.symbol_of[text]
        cut = np.ones(len(text) + 1, bool)
        cut[1:-1] = ~self.joins[symbols[:-1].astype(np.int64) * self.size + symbols[1:]]
        cut[rows] = True
        edges = np.flatnonzero(cut)
        start, end = edges[:-1], edges[1:]
        plain = symbols[start] > 0
        hashes = span_hashes(self.symbol_values[symbols], start[plain], end[plain])
        values, at, size = self.memory(symbols, hashes, start[plain], end[plain])
        # Other characters, one a span, become their UTF-8 bytes.
        other = text[start[~plain]]
        width = np.zeros(len(start), np.int64)
        width[plain] = size
        width[~plain] = 1 + (other >= 0x80) + (other >= 0x800) + (other >= 0x10000)
        out = np.zeros(int(width.sum()), np.int32)
        to = np.cumsum(width) - width
        numbers = values[gather(at, size)]
        out[gather(to[plain], size)] = self.ids[numbers]
        octets = np.frombuffer(other.astype("<u4").tobytes().decode("utf-32-le", "replace").encode(), np.uint8)
        out[gather(to[~plain], width[~plain])] = self.byte_ids[octets]
        counts = np.add.reduceat(np.append(width, 0), np.searchsorted(start, rows[:-1])) * full
        return self._join_runs(out, counts)

    def _join_runs(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace neighbouring single space marks by the run pieces."""
        single = ids == self.ids[self.mark]
        row = np.repeat(np.arange(len(counts)), counts)
        double = np.flatnonzero(single[1:] & single[:-1] & (row[1:] == row[:-1]))
        if not len(double):
            return ids, counts
        counts = counts.copy()
        parts, done = [], 0
        heads = double[np.concatenate([[True], np.diff(double) > 1])]
        tails = double[np.concatenate([np.diff(double) > 1, [True]])] + 2
        for a, b in zip(heads.tolist(), tails.tolist(), strict=True):
            run = self.run_ids(b - a)
            parts += [ids[done:a], run]
            counts[row[a]] += len(run) - (b - a)
            done = b
        return np.concatenate([*parts, ids[done:]]), counts

    def decode(self, column: pa.Array) -> pa.Array:
        """Texts of lists of ids. Bytes that are not UTF-8 become U+FFFD; the unknown id is printed as the model does."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        sizes = np.asarray(column.value_lengths().fill_null(0))
        every = np.asarray(column.flatten())
        done, out = 0, []
        rows = np.concatenate([[0], np.cumsum(sizes)])
        while done < len(sizes):
            upto = min(max(int(np.searchsorted(rows, rows[done] + BATCH_IDS, "right")) - 1, done + 1), len(sizes))
            out.append(self._decode_rows(every[rows[done] : rows[upto]], rows[done : upto + 1] - rows[done]))
            done = upto
        return pa.concat_arrays(out) if out else pa.array([], pa.string())

    def _decode_rows(self, ids: np.ndarray, rows: np.ndarray) -> pa.Array:
        start = self.byte_starts[ids]
        width = self.byte_starts[ids + 1] - start
        ends = np.concatenate([[0], np.cumsum(width)])
        raw = self.all_bytes[gather(start, width)]
        # The dummy prefix goes: a space that begins a text.
        offsets = ends[rows]
        full = offsets[1:] > offsets[:-1]
        lead = offsets[:-1][full]
        lead = lead[raw[lead] == 32]
        gone = np.zeros(len(raw) + 1, np.int64)
        gone[lead + 1] = 1
        offsets = offsets - np.cumsum(gone)[offsets]
        raw = np.delete(raw, lead)
        array = pa.StringArray.from_buffers(
            len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())
        )
        try:
            array.validate(full=True)
            return array
        except pa.ArrowInvalid:
            octets = raw.tobytes()
            return pa.array([octets[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:], strict=False)])


_models: dict[str, PieceModel] = {}


def piece_model(path: str = MODEL) -> PieceModel:
    """The model, loaded once per worker."""
    path = os.fspath(path)
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode(text: Column, model: str = MODEL) -> Column:
    """Column of id lists."""

    @F.arrow_udf("array<int>")
    def sentencepiece_encode(texts: pa.Array) -> pa.Array:
        return piece_model(model).encode(texts)

    return sentencepiece_encode(text.cast("string"))


def decode(ids: Column, model: str = MODEL) -> Column:
    """Column of texts."""

    @F.arrow_udf("string")
    def sentencepiece_decode(lists: pa.Array) -> pa.Array:
        return piece_model(model).decode(lists)

    return sentencepiece_decode(ids)


def encode_documents(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``docs`` with a column of ids."""
    with_workers(docs.sparkSession)
    return docs.withColumn(ids_col, encode(F.col(text_col), model))


def decode_documents(docs: DataFrame, ids_col: str = "ids", text_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """``docs`` with a column of the texts that the ids stand for."""
    with_workers(docs.sparkSession)
    return docs.withColumn(text_col, decode(F.col(ids_col), model))
