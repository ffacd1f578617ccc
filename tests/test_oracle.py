"""Every registered query equals its DuckDB oracle (the driver's correctness gate)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF001, SF01
from oracle import duck, duck_rows, fingerprint, spark_rows

# The training-data queries, where present, have tests of their own.
KEYS = sorted(set(entry.queries()) - set(entry.LLM_QUERIES) - {"pipeline"})


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    got = fingerprint(*spark_rows(entry.queries()[key](spark, SF01)))
    want = fingerprint(*duck_rows(con, entry.oracle_sql()[key]))
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 660
    assert df.columns == [
        "province",
        "province_iso_3316_code",
        "click_count",
        "focus_count",
        "buy_count",
        "window_start",
        "window_end",
    ]


def test_flagship_sizes_sf0001(spark):
    # Row counts of the four dashboards on the smallest tables (prototyped).
    q = entry.queries()
    assert q["member_total"](spark, SF001).count() == 236
    assert q["item_total"](spark, SF001).count() == 995
    assert q["cat_window"](spark, SF001).count() == 416
