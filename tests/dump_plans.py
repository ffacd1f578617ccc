"""CLI: write PLANS.md, the physical plans of every registered batch query.

    python tests/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from clickpulse.plans.catalog import BATCH_QUERIES  # noqa: E402
from clickpulse.session import get_session  # noqa: E402

HEADER = """# PLANS

Physical plans of every registered batch query at sf0.1 on `local[8]`, as planned
before run time (AQE may still coalesce partitions, reuse exchanges or turn a join into a
broadcast), from `explain("formatted")`: the operator tree, then
each scan's `ReadSchema` and `PushedFilters`. Generated from the code by
`tests/dump_plans.py`; `Exchange` = shuffle, `BroadcastExchange` = the `part` lookup, by
Spark's own size check.
The `*_job_balance` queries run at once, as one aggregation over one parse of the
messages (`jobs.job_balance`, `tests/test_state.py`), and return their one row.
"""


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def main(argv: list[str]) -> None:
    sf = argv[0] if argv else "/root/testdata/sf0.1"
    spark = get_session(master="local[8]", shuffle_partitions=8)
    out = [HEADER]
    for name, fn in BATCH_QUERIES.items():
        text = formatted(fn(spark, sf))
        tree = text.split("\n\n\n")[0].split("+- == Initial Plan ==")[0].rstrip()
        scans = sorted({ln.strip() for ln in text.splitlines() if ln.startswith(("ReadSchema", "PushedFilters"))})
        out += [f"## {name}", "", "```", tree, "```", ""]
        if scans:
            out += ["```", *scans, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main(sys.argv[1:])
