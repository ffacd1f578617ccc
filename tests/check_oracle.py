"""CLI: run every registered query and its oracle, print one line per key.

    python tests/check_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import duck, duck_rows, fingerprint, spark_rows  # noqa: E402

from clickpulse.session import get_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = get_session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        cols, rows = spark_rows(fn(spark, sf_dir))
        dt = time.time() - t
        s = fingerprint(cols, rows)
        if name not in oracles:
            print(f"{name:24s} rows={s[0]:7d} (no oracle) {dt:.2f}s")
            continue
        o = fingerprint(*duck_rows(con, oracles[name]))
        ok = s == o
        bad += not ok
        detail = "" if ok else f"\n   spark={s}\n   duck ={o}"
        print(f"{name:24s} rows={s[0]:7d} {'OK ' if ok else 'BAD'} {dt:.2f}s{detail}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
