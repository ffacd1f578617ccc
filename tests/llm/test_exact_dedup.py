from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from conftest import SF001, SF01
from llm_data import odd_rows, table
from oracle import duck, duck_rows, fingerprint, spark_rows
from pyspark.sql import functions as F

from clickpulse.llm.exact_dedup import deduplicate, mark_copies
from clickpulse.llm.queries import LLM_ORACLE, LLM_QUERIES


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        best = min((m for m in members if m[0] is not None), key=lambda m: (-len(m[1]), m[0]), default=(None, ""))
        for doc_id, _ in members:
            out.append((doc_id, best[0], len(members), doc_id == best[0], hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_equals_sql(spark, sf):
    got = fingerprint(*spark_rows(LLM_QUERIES["op1_exact_dedup"](spark, sf)))
    assert got == fingerprint(*duck_rows(duck(sf), LLM_ORACLE["op1_exact_dedup"]))


@pytest.mark.parametrize("digest", [None, lambda c: F.length(c).cast("string")], ids=["sha256", "colliding digest"])
def test_odd_rows_and_digests_that_collide(spark, digest):
    rows = odd_rows()
    more = {} if digest is None else {"digest": digest}
    got = mark_copies(table(spark, rows).repartition(5), salts=3, **more).collect()
    assert sorted(map(tuple, got), key=str) == brute([r[:2] for r in rows])


def test_hot_group_over_many_partitions(spark):
    docs = spark.range(5_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot text")).otherwise(F.col("id").cast("string")).alias("text")
    )
    got = mark_copies(docs.repartition(40)).where("group_size > 1").collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(0, 1667)} and sum(r.kept for r in got) == 1


def test_keeps_columns_and_one_row_of_each(spark):
    rows = [(3, "a b"), (1, "ab"), (2, " ab"), (4, None), (5, "  "), (6, "c")]
    docs = table(spark, rows)
    got = deduplicate(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [2, 5, 6]


def test_empty_table(spark):
    assert mark_copies(table(spark, [])).collect() == []
    assert deduplicate(table(spark, [])).collect() == []


def test_plan_has_no_python(spark):
    plan = mark_copies(table(spark, odd_rows(10)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
