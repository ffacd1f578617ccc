"""Suffix-array deduplication: remove every byte that a repeated 200-byte string covers.

A text is its UTF-8 bytes. A string of ``WIDTH`` bytes is repeated when it also
starts anywhere else, in the same text or another; matches never cross texts.
All strings are judged on the input. Every byte of every repeated string goes.

Suffix arrays are built per shard, and equal strings must meet in one shard:

1. Anchors. Of the 64-byte grams inside a string, the one with the least hash (the
   last of equals) is its anchor. It depends on the string alone, so equal strings
   have equal anchors at equal places, and a text's strings fall into runs with one
   anchor each. A run's bytes are a fragment.
2. An anchor that occurs once cannot hold a repeated string. A fragment whose whole
   content occurs again (two 64-bit hashes) consists of repeated strings.
3. The distinct fragments of the other anchors go to shards by anchor. A shard's
   text gets a suffix array by induced sorting; a string is repeated if its suffix
   shares ``WIDTH`` bytes with a neighbour in the array, which the permuted common
   prefixes tell. The fragments of a text hold each of its strings once, so every
   match found is one between different places.
4. An anchor with more than ``CROWD`` distinct fragments would make a shard of
   unbounded size; its strings are counted by their two hashes instead.

Then each text drops its covered bytes. A content is read from one of its places
only, whatever the number of its copies.

Null and empty texts, and texts below ``WIDTH`` bytes, have no spans. Rows that repeat
an id and a text are copies of each other and lose all their strings. Null ids
are a value like any other. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import bit_table, bits_set, stored, with_workers
from clickpulse.llm.sais import permuted_lcp, suffix_array
from clickpulse.llm.spans import gather
from clickpulse.llm.words import chunks

WIDTH = 200
GRAM = 64
#: Distinct fragments of one anchor that a shard takes.
CROWD = 4096
#: Bytes of fragments in a shard, on average.
SHARD_BYTES = 1 << 20
#: Text bytes scanned at once: the arrays of this size stay in a core's cache.
SCAN_BYTES = 1 << 17
#: Bits of the filter for anchors seen twice (4 MB, fixed); a full one only passes on more rows.
FILTER_BITS = 1 << 25
#: Places are told apart by so many bits while anchors are chosen; longer texts are gone through in parts.
PLACE_BITS = 24
_SEPARATOR = 0xFE  # never a byte of UTF-8

_U = np.uint64
_rng = np.random.default_rng(90210)
_VALUES = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _tables.get(which)
    if have is None or len(have[0]) < n:
        up, down = np.full(n, _BASES[which], np.uint64), np.full(n, pow(_BASES[which], -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = _tables[which] = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return have


class Prefixes:
    """Hashes of any spans of a byte array."""

    def __init__(self, raw: np.ndarray, which: int):
        up, self.down = _powers(which, max(len(raw) + 1, 1 << 20))
        self.total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_VALUES[which][raw] * up[: len(raw)], out=self.total[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.total[end] - self.total[start]) * self.down[start]
        h ^= h >> _U(29)
        h *= _U(0xBF58476D1CE4E5B9)
        return h ^ (h >> _U(32))

    def grams(self, n: int) -> np.ndarray:
        """Of every place where ``n`` bytes begin."""
        h = (self.total[n:] - self.total[:-n]) * self.down[: len(self.total) - n]
        h ^= h >> _U(29)
        h *= _U(0xBF58476D1CE4E5B9)
        return h ^ (h >> _U(32))


def _least_grams(grams: np.ndarray) -> np.ndarray:
    """The place of the least gram (the last of equals) of each run of as many grams as a string has.

    Grams are compared by their highest 64 - ``PLACE_BITS`` bits, whatever the size of the text, so that
    equal strings choose alike wherever they stand.
    """
    wanted, mask = WIDTH - GRAM + 1, (1 << PLACE_BITS) - 1
    step = mask - wanted
    out = []
    for lo in range(0, len(grams) - wanted + 1, step):
        part = grams[lo : lo + step + wanted - 1]
        # Least hash, then last place, as one number: the place's bits replace the hash's lowest.
        key = (part & _U(~mask & (2**64 - 1))) | (_U(mask) - np.arange(len(part), dtype=np.uint64))
        size = 1
        while size * 2 <= wanted:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if wanted > size:
            key = np.minimum(key[: len(key) - (wanted - size)], key[wanted - size :])
        out.append((_U(mask) - (key & _U(mask))).astype(np.int64) + lo)
    return out[0] if len(out) == 1 else np.concatenate(out)


def fragments(raw: np.ndarray, offsets: np.ndarray, first: Prefixes) -> tuple[np.ndarray, ...]:
    """``(row, anchor hash, first string's start, last string's start, anchor's place)`` of each run, in the chunk's bytes."""
    none = np.zeros(0, np.int64)
    n = len(raw)
    if n < WIDTH:
        return none, none, none, none, none
    grams = first.grams(GRAM)
    place = _least_grams(grams)  # anchor of the string at each start
    counts = np.maximum(np.diff(offsets) - WIDTH + 1, 0)
    start = gather(offsets[:-1], counts)  # strings that lie inside one row
    row = np.repeat(np.arange(len(counts)), counts)
    at = place[start]
    head = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1])])) if len(at) else none
    tail = np.append(head[1:], len(at)) - 1
    return row[head], grams[at[head]].view(np.int64), start[head], start[tail], at[head]


#: A text: its id, and two 64-bit hashes of it, as ids may be null or repeat.
IDENTITY = ["doc_id", "tag", "tag2"]


def _identity(batch: pa.RecordBatch, rows: pa.Array) -> list[pa.Array]:
    return [batch[c].take(rows) for c in IDENTITY]


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    return bits_set(bits, h & (FILTER_BITS - 1))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, raw, offsets in chunks(batch["text"], SCAN_BYTES):
            _, anchor, _, _, _ = fragments(raw, offsets, Prefixes(raw, 0))
            yield pa.record_batch([pa.array(anchor)], names=["anchor"])


def _occurrences(bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, raw, offsets in chunks(batch["text"], SCAN_BYTES):
                one, two = Prefixes(raw, 0), Prefixes(raw, 1)
                row, anchor, a, b, place = fragments(raw, offsets, one)
                keep = _has(bits, anchor)
                row, anchor, a, b, place = row[keep], anchor[keep], a[keep], b[keep], place[keep]
                k1, k2 = _content(one, two, a, b, place)
                rows = pa.array(row + lo)
                yield pa.record_batch(
                    [
                        *_identity(batch, rows), pa.array(anchor), pa.array(k1), pa.array(k2),
                        pa.array(a - offsets[row]), pa.array(b - offsets[row]),
                    ],
                    names=[*IDENTITY, "anchor", "k1", "k2", "a", "b"],
                )

    return run


def _content(one: Prefixes, two: Prefixes, a: np.ndarray, b: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of a fragment: its bytes, its length and where its anchor is."""
    shape = ((b - a) * WIDTH + place - a).astype(np.uint64) * _U(0x9E3779B97F4A7C15)
    return (one.spans(a, b + WIDTH) ^ shape).view(np.int64), (two.spans(a, b + WIDTH) + shape).view(np.int64)


#: Tells the places of one content apart: the least value of a content picks the place it is read from.
PLACE = "k1 ^ shiftleft(coalesce(doc_id, 0L), 24) ^ shiftleft(tag, 9) ^ a"


def _contents(bits: np.ndarray):
    """The bytes of the fragments at these places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ident = np.asarray(batch["doc_id"].fill_null(0)) << 24
            ident = ident ^ (np.asarray(batch["tag"]) << 9)
            for lo, _, raw, offsets in chunks(batch["text"], SCAN_BYTES):
                one, two = Prefixes(raw, 0), Prefixes(raw, 1)
                row, anchor, a, b, place = fragments(raw, offsets, one)
                k1, k2 = _content(one, two, a, b, place)
                keep = np.flatnonzero(_has(bits, k1 ^ ident[row + lo] ^ (a - offsets[row])))
                k1, k2 = k1[keep], k2[keep]
                row, anchor, a, b = row[keep], anchor[keep], a[keep], b[keep]
                size = b + WIDTH - a
                ends = np.zeros(len(a) + 1, np.int32)
                np.cumsum(size, out=ends[1:])
                data = pa.Array.from_buffers(
                    pa.binary(), len(a), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw[gather(a, size)].tobytes())]
                )
                rows = pa.array(row + lo)
                yield pa.record_batch(
                    [
                        *_identity(batch, rows), pa.array(anchor), pa.array(k1), pa.array(k2),
                        pa.array(a - offsets[row]), data,
                    ],
                    names=[*IDENTITY, "anchor", "k1", "k2", "a", "data"],
                )

    return run


def repeated_starts(pieces: list[bytes]) -> list[np.ndarray]:
    """For each distinct piece, where in it a string of ``WIDTH`` bytes starts that also starts elsewhere in the pieces."""
    text = np.frombuffer(b"".join(p + bytes([_SEPARATOR]) for p in pieces), np.uint8)
    text = np.append(text + 1, 0).astype(np.uint8)
    sa = suffix_array(text, 256)
    shared = permuted_lcp(text, sa)
    long = shared >= WIDTH
    # The predecessor of a long match is one as well.
    previous = np.zeros(len(text), bool)
    rank = np.flatnonzero(long[sa])
    previous[sa[rank - 1]] = True
    hit = long | previous
    sizes = np.array([len(p) + 1 for p in pieces])
    first = np.cumsum(sizes) - sizes
    return [np.flatnonzero(hit[f : f + s - WIDTH]) for f, s in zip(first.tolist(), sizes.tolist(), strict=True)]


def _ranges(starts: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges that strings at these sorted starts cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > WIDTH)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + WIDTH).tolist(), strict=True))


def _search_shard(group: pd.DataFrame) -> pd.DataFrame:
    group = group.drop_duplicates(["anchor", "k1", "k2"])
    out = []
    found = repeated_starts([bytes(d) for d in group["data"]])
    for *ident, a, starts in zip(*(group[c] for c in IDENTITY), group["a"], found, strict=True):
        out += [(*ident, a + lo, a + hi) for lo, hi in _ranges(starts)]
    out = pd.DataFrame(out, columns=[*IDENTITY, "lo", "hi"])
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of every string of the fragments, for crowded anchors."""
    for batch in batches:
        for lo, _, raw, offsets in chunks(batch["data"], SCAN_BYTES):
            counts = np.diff(offsets) - WIDTH + 1
            start = gather(offsets[:-1], counts)
            row = np.repeat(np.arange(len(counts)), counts)
            one, two = Prefixes(raw, 0), Prefixes(raw, 1)
            rows = pa.array(row + lo)
            a = np.asarray(batch["a"])[row + lo] + start - offsets[row]
            yield pa.record_batch(
                [
                    *_identity(batch, rows), pa.array(a),
                    pa.array(one.spans(start, start + WIDTH).view(np.int64)), pa.array(two.spans(start, start + WIDTH).view(np.int64)),
                ],
                names=[*IDENTITY, "lo", "w1", "w2"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, spans, kept = [], [], [], []
        for text, ranges in zip(batch["text"], batch["ranges"], strict=True):
            raw = np.frombuffer((text.as_py() or "").encode(), np.uint8)
            edges = np.zeros(len(raw) + 1, np.int32)
            if ranges.values is not None and len(ranges.values):
                lo, hi = (np.asarray(ranges.values.field(k)) for k in ("lo", "hi"))
                np.add.at(edges, lo, 1)
                np.add.at(edges, hi, -1)
            gone = np.cumsum(edges[:-1]) > 0
            flips = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            sizes.append(len(raw))
            removed.append(int(gone.sum()))
            spans.append([{"start": a, "end": b} for a, b in flips.reshape(-1, 2).tolist()])
            kept.append(raw[~gone].tobytes())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.record_batch(
            [
                batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind),
                pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def _has_range(batch: pa.RecordBatch, bits: np.ndarray) -> np.ndarray:
    return bits_set(bits, batch["s"].to_numpy(zero_copy_only=False))


def _touched(bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_has_range(batch, bits))).select([*IDENTITY, "text"])

    return run


def _untouched(bits: np.ndarray):
    """Texts of which nothing goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~_has_range(batch, bits)))
            kept = batch["text"].cast(pa.binary())
            n = batch.num_rows
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            sizes = pa.compute.cast(pa.compute.binary_length(kept), pa.int64())
            yield pa.record_batch(
                [batch["doc_id"], sizes, pa.array(np.zeros(n, np.int64)), pa.array([[]] * n, kind), kept],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` for every row: removed byte ranges and the bytes that stay."""
    with_workers(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("tag"),
        F.xxhash64(F.lit("second"), text).alias("tag2"),
        text.alias("text"),
    )

    # 1., 2. anchors and contents that occur again
    common = texts.select("text").mapInArrow(_anchors, "anchor long").groupBy("anchor").agg(F.count(F.lit(1)).alias("c"))
    seen = bit_table(F.expr(f"anchor & {FILTER_BITS - 1}L"), common.where("c > 1"), FILTER_BITS)
    ident = "doc_id long, tag long, tag2 long"
    where = f"{ident}, anchor long, k1 long, k2 long"
    places = stored(texts.mapInArrow(_occurrences(seen), f"{where}, a long, b long"), "suffix-places")
    contents = places.groupBy("anchor", "k1", "k2").agg(
        F.count(F.lit(1)).alias("c"), F.max(F.col("b") - F.col("a") + WIDTH).alias("size"), F.min(F.expr(PLACE)).alias("place")
    )
    contents = stored(contents, "suffix-contents")
    whole = places.join(contents.where("c > 1").select("k1", "k2", "anchor"), ["k1", "k2", "anchor"], "left_semi")
    ranges = whole.select(*IDENTITY, F.col("a").alias("lo"), (F.col("b") + WIDTH).alias("hi"))

    # 3. anchors with several contents, not all of which occur again
    mixed = contents.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"), F.min("c").alias("least"), F.sum("size").alias("bytes")
    )
    mixed = stored(mixed.where("kinds > 1 AND least = 1"), "suffix-mixed")
    total = mixed.where(F.col("kinds") <= CROWD).agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_BYTES))
    wanted = contents.join(mixed, "anchor", "left_semi")
    wanted = bit_table(F.expr(f"place & {FILTER_BITS - 1}L"), wanted, FILTER_BITS)
    pieces = stored(texts.mapInArrow(_contents(wanted), f"{where}, a long, data binary"), "suffix-pieces")
    # A table of its own: its size, known to the planner, decides whether it is broadcast.
    crowded = stored(mixed.where(F.col("kinds") > CROWD).select("anchor"), "suffix-crowded")
    sharded = pieces.join(crowded, "anchor", "left_anti").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    ranges = ranges.unionByName(
        sharded.groupBy("shard").applyInPandas(_search_shard, f"{ident}, lo long, hi long")
    )

    # 4. crowded anchors
    if not crowded.isEmpty():
        many = pieces.join(crowded, "anchor", "left_semi").dropDuplicates(["anchor", "k1", "k2"])
        strings = stored(
            many.select(*IDENTITY, "a", "data").mapInArrow(_strings, f"{ident}, lo long, w1 long, w2 long"),
            "suffix-strings",
        )
        again = strings.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        strings = strings.join(again.select("w1", "w2"), ["w1", "w2"], "left_semi")
        ranges = ranges.unionByName(strings.select(*IDENTITY, "lo", (F.col("lo") + WIDTH).alias("hi")))

    # One list per text, not longer than the text, whatever the number of its rows. Texts without any are not moved.
    named = {c: f"_{c}" for c in IDENTITY}
    ranges = ranges.distinct().groupBy(*IDENTITY).agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    ranges = stored(ranges.withColumnsRenamed(named), "suffix-ranges")
    spot = lambda *key: F.pmod(F.xxhash64(*key), F.lit(FILTER_BITS))
    touched = bit_table(spot(*named.values()), ranges, FILTER_BITS)
    spotted = texts.select(*IDENTITY, "text", spot(*IDENTITY).alias("s"))
    result = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
    whole = spotted.mapInArrow(_untouched(touched), result)
    some = spotted.mapInArrow(_touched(touched), f"{ident}, text string")
    same = some["doc_id"].eqNullSafe(ranges["_doc_id"]) & (some["tag"] == ranges["_tag"]) & (some["tag2"] == ranges["_tag2"])
    joined = some.join(ranges, same, "left")
    return whole.unionByName(joined.select("doc_id", "text", "ranges").mapInArrow(_cut, result))
