from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from clickpulse.session import get_session

    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    b.getOrCreate()
    s = get_session(shuffle_partitions=8)
    # Tests get their own shared folder only where the session names none.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clickpulse-test-"))
    yield s


@pytest.fixture()
def scratch(spark):
    from clickpulse.session import scratch_path

    return lambda name: scratch_path(spark, "test", name)
