from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from conftest import SF01
from llm_data import odd_rows, table

from clickpulse.llm.queries import LLM_QUERIES
from clickpulse.llm.sharding import assign_shards, write_shards


def check_law(rows, n, total):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert len(rows) == total and set(by) <= set(range(n))
    assert max(map(len, by.values())) - min(len(by.get(k, [])) for k in range(n)) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = LLM_QUERIES["op6_sharding"](spark, SF01).collect()
    check_law(rows, 24, len(docs))
    for r in rows:
        data = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)


def xx(data, seed=42):
    return xxhash.xxh64(data, seed=seed).intdigest()


def mod(h, n):
    return (h - 2**64 if h >= 2**63 else h) % n


def placed(rows, n):
    """The placement by sorting whole sources, and then all rows: ``(doc_id, text crc) -> (shard, slot)``."""
    by_source = defaultdict(list)
    for doc_id, text, source in rows:
        data = (text or "").encode()
        h = xx(doc_id.to_bytes(8, "little", signed=True))
        h = xx((17).to_bytes(4, "little"), xx(zlib.crc32(data).to_bytes(8, "little"), h))
        by_source[source].append((mod(h, 2**52), doc_id, len(data) + 8, zlib.crc32(data)))
    order = []
    for source, own in by_source.items():
        seed = 42 if source is None else xx(source.encode())
        shift = mod(xx((18).to_bytes(4, "little"), seed), 2**52) / float(2**52)
        order += [((k + shift) / len(own), source or "", r) for k, r in enumerate(sorted(own))]
    order.sort()
    out = {}
    for place, (_, _, r) in enumerate(order):
        shard = place * n // len(order)
        out[r[1], r[3]] = (shard, place - (shard * len(order) + n - 1) // n)
    return out


def test_query_equals_plain_sorting(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").collect()
    want = placed([(r.doc_id, r.text, r.source) for r in docs], 24)
    got = {(r.doc_id, r.text_crc32): (r.shard, r.slot) for r in LLM_QUERIES["op6_sharding"](spark, SF01).collect()}
    assert got == want and len(got) == len(docs)


@pytest.mark.parametrize("bucket_rows", [8_192, 7])
def test_every_shard_has_the_mixture(spark, bucket_rows):
    docs = spark.createDataFrame([(k, f"t{k}", None, "hot" if k % 3 else f"s{k % 7}") for k in range(2_000)], "doc_id long, text string, x int, source string")
    rows = assign_shards(docs, 8, bucket_rows=bucket_rows).collect()
    check_law(rows, 8, 2_000)
    share = Counter(r.source for r in rows)
    per_shard = Counter((r.shard, r.source) for r in rows)
    for source, n in share.items():
        assert all(abs(per_shard[k, source] - n / 8) <= 2 for k in range(8))


def test_same_result_whatever_the_partitions_and_buckets(spark):
    docs = table(spark, [(k, "x" * (k % 5), None, f"s{k % 3}") for k in range(300)])
    one = {(r.doc_id, r.shard, r.slot) for r in assign_shards(docs, 5).collect()}
    two = {(r.doc_id, r.shard, r.slot) for r in assign_shards(docs.repartition(9), 5, bucket_rows=11).collect()}
    assert one == two


def test_odd_rows_and_empty_table(spark, scratch):
    rows = assign_shards(table(spark, odd_rows(100)), 4).collect()
    check_law(rows, 4, len(odd_rows()))
    assert {r.size for r in rows if r.doc_id == 1} == {8}
    assert assign_shards(table(spark, []), 4).collect() == []
    path = scratch("shards")
    write_shards(assign_shards(table(spark, odd_rows(100)), 4), path)
    assert spark.read.parquet(path).count() == len(odd_rows())
