"""

``entry(spark)`` runs the flagship query (province totals, job 4) on sf0.001;
``queries()`` names every implemented operator as a query over the driver's
tables; ``oracle_sql()`` gives, for each, the same result as DuckDB SQL over
the same parquet views. Window widths are the production ones scaled from
seconds to hours (see ``clickpulse.plans.catalog``).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Loadable by file path from any working directory: the package sits next to this file.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from clickpulse.functions.regions import REGION_CODES  # noqa: E402
from clickpulse.plans.catalog import BATCH_QUERIES, q_province_window  # noqa: E402
from clickpulse.sources.testdata import FIXTURE_PROVINCES  # noqa: E402

# The training-data operators and their pipeline are optional: without those files
# everything else works. An import error inside them is not swallowed.
try:
    import corpus_pipeline
    from clickpulse.llm.queries import LLM_ORACLE, LLM_QUERIES
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "clickpulse.llm", "clickpulse.llm.queries"):
        raise
    corpus_pipeline, LLM_ORACLE, LLM_QUERIES = None, {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return q_province_window(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(BATCH_QUERIES)
    try:
        from clickpulse.streaming.replay import STREAM_QUERIES
    except ImportError:  # pragma: no cover - streaming part missing
        STREAM_QUERIES = {}
    out.update(STREAM_QUERIES)
    out.update(LLM_QUERIES)
    if corpus_pipeline is not None:
        out["pipeline"] = corpus_pipeline.run
    return out


# --------------------------------------------------------------------------
# DuckDB oracle
# --------------------------------------------------------------------------


def _values(rows) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


_K = "json_extract_string(e.props, '$.k')"
_UB = f"""
ub AS (
  SELECT e.event_id AS event_id,
         CAST(e.user_id AS VARCHAR) AS user_id,
         CAST({_K} AS VARCHAR) AS item_id,
         p.p_type AS cat_id,
         CAST(CAST({_K} AS BIGINT) % 10 AS VARCHAR) AS merchant_id,
         p.p_brand AS brand_id,
         CASE e.event_type WHEN 'click' THEN '0' WHEN 'signup' THEN '1'
                           WHEN 'purchase' THEN '2' WHEN 'view' THEN '3'
                           ELSE '9' END AS action,
         CAST(e.user_id % 9 AS VARCHAR) AS age_range,
         CAST(e.user_id % 3 AS VARCHAR) AS gender,
         pv.province AS province,
         epoch_us(e.ts) // 1000 AS event_ms,
         e.ts AS ts
  FROM events e
  JOIN part p ON p.p_partkey = CAST({_K} AS BIGINT)
  JOIN (VALUES {_values(enumerate(FIXTURE_PROVINCES))}) AS pv(idx, province)
    ON pv.idx = e.user_id % {len(FIXTURE_PROVINCES)}
)"""
_CODES = f"(VALUES {_values(REGION_CODES)}) AS rc(province, code)"
_FIELDS = "user_id, item_id, cat_id, merchant_id, brand_id, action, age_range, gender, province, event_ms"
_ACODE = "TRY_CAST(action AS INTEGER)"
_NORM = "CASE WHEN ends_with(province, '市') THEN replace(province, '市', '') ELSE province END"


def _bucket(hours: int, col: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{hours} hours', {col}, TIMESTAMP '1970-01-01')"


def _cnt(code: int) -> str:
    return f"CAST(SUM(CASE WHEN {_ACODE} = {code} THEN 1 ELSE 0 END) AS BIGINT)"


def _with(body: str) -> str:
    return f"WITH {_UB}\n{body}"


# The damage of ``raw_messages``, by event_id % 97: 0 no JSON, 1 no action, 2 empty action, 3 no
# province, 4 no category, 5 a time that is no number.
_DAMAGED = (
    _FIELDS.replace("cat_id", "CASE WHEN event_id % 97 = 4 THEN NULL ELSE cat_id END AS cat_id")
    .replace("province", "CASE WHEN event_id % 97 = 3 THEN NULL ELSE province END AS province")
    .replace("event_ms", "CASE WHEN event_id % 97 = 5 THEN NULL ELSE event_ms END AS event_ms")
)
_REASON = (
    "CASE event_id % 97 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no action' WHEN 2 THEN 'bad action' WHEN 3 THEN 'no province'"
    " WHEN 5 THEN 'no time' ELSE CASE WHEN event_id % 97 = 4 AND action = '0' THEN 'no category' END END"
)


# Why each job rejects a message, in event time.
_JOB_REASON = {
    "member_total": "CASE event_id % 97 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no action' WHEN 2 THEN 'bad action' WHEN 5 THEN 'no time' END",
    "item_total": "CASE event_id % 97 WHEN 0 THEN 'malformed' WHEN 5 THEN 'no time' END",
    "cat_window": "CASE event_id % 97 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no action' WHEN 2 THEN 'bad action' WHEN 5 THEN 'no time'"
    " WHEN 4 THEN CASE WHEN action = '0' THEN 'no category' END END",
    "province_window": "CASE event_id % 97 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no action' WHEN 2 THEN 'bad action'"
    " WHEN 3 THEN 'no province' WHEN 5 THEN 'no time' END",
}


def _balance(rejected: str, counted: str) -> str:
    """All messages of a job: those it accepts, those it rejects, and the sum of its counters."""
    return _with(
        f"SELECT COUNT(*) AS messages, CAST(SUM(CASE WHEN {rejected} THEN 0 ELSE 1 END) AS BIGINT) AS accepted,"
        f" CAST(SUM(CASE WHEN {rejected} THEN 1 ELSE 0 END) AS BIGINT) AS rejected,"
        f" CAST(({counted.replace('CASE WHEN', f'CASE WHEN ({rejected}) THEN 0 WHEN')}) AS BIGINT) AS counted"
        f" FROM (SELECT event_id % 97 AS m, {_ACODE} AS code FROM ub) b"
    )


_MEMBER = f"""
SELECT {_bucket(3)} AS window_start, {_bucket(3)} + INTERVAL '3 hours' AS window_end,
       {_cnt(0)} AS click_count, {_cnt(1)} AS addcart_count, {_cnt(2)} AS buy_count, {_cnt(3)} AS focus_count
FROM ub GROUP BY 1, 2"""

_ITEM = f"""
SELECT item_id, action, MAX(cat_id) AS cat_id, MAX(brand_id) AS brand_id,
       CASE WHEN action = '0' THEN COUNT(*) ELSE 0 END AS item_click_count,
       CASE WHEN action = '2' THEN COUNT(*) ELSE 0 END AS item_sale_count,
       CASE WHEN action = '3' THEN COUNT(*) ELSE 0 END AS item_focus_count,
       {_bucket(3)} AS window_start, {_bucket(3)} + INTERVAL '3 hours' AS window_end
FROM ub GROUP BY item_id, action, {_bucket(3)}"""

_CAT = f"""
SELECT cat_id, COUNT(*) AS cat_click_count,
       pane - to_hours(10 * i) AS window_start,
       pane - to_hours(10 * i) + INTERVAL '60 hours' AS window_end
FROM (SELECT cat_id, {_bucket(10)} AS pane, UNNEST(range(6)) AS i
      FROM ub WHERE {_ACODE} = 0 AND cat_id IS NOT NULL) s
GROUP BY cat_id, pane - to_hours(10 * i)"""

_PROVINCE = f"""
SELECT n.province, COALESCE(rc.code, '') AS province_iso_3316_code,
       {_cnt(0)} AS click_count, {_cnt(3)} AS focus_count, {_cnt(2)} AS buy_count,
       {_bucket(10)} AS window_start, {_bucket(10)} + INTERVAL '10 hours' AS window_end
FROM (SELECT {_NORM} AS province, action, ts FROM ub WHERE province IS NOT NULL) n
LEFT JOIN {_CODES} ON rc.province = n.province
GROUP BY n.province, rc.code, {_bucket(10)}"""

_RUN = ", ".join(
    f"CAST(SUM({c}) OVER (ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS {c}"
    for c in ("click_count", "addcart_count", "buy_count", "focus_count")
)

_ORACLE: dict[str, str] = {
    "parse_events": _with(
        f"SELECT event_id, {_DAMAGED}, CAST(action AS INTEGER) AS action_code FROM ub WHERE event_id % 97 NOT IN (0, 1, 2)"
    ),
    "json_round_trip": _with(f"SELECT event_id, {_FIELDS} FROM ub"),
    "csv_feed": _with(
        "SELECT user_id, item_id, CASE WHEN event_id % 83 = 0 THEN '' ELSE cat_id END AS cat_id, merchant_id, brand_id,"
        " action, age_range, gender, CASE WHEN event_id % 89 = 0 THEN '' ELSE province END AS province FROM ub"
    ),
    "click_filter": _with(f"SELECT event_id, cat_id FROM ub WHERE {_ACODE} = 0"),
    "action_flags": _with(
        "SELECT event_id, "
        + ", ".join(
            f"CASE WHEN {_ACODE} = {code} THEN 1 ELSE 0 END AS {name}"
            for code, name in ((0, "click"), (1, "addcart"), (2, "buy"), (3, "focus"))
        )
        + " FROM ub"
    ),
    "reject_events": _with(
        f"SELECT event_id, reason AS reject_reason FROM (SELECT event_id, {_REASON} AS reason FROM ub) r WHERE reason IS NOT NULL"
    ),
    "job_reject_feed": _with(
        " UNION ALL ".join(
            f"SELECT event_id, '{job}' AS job, reason AS reject_reason FROM (SELECT event_id, {reason} AS reason FROM ub) r"
            " WHERE reason IS NOT NULL"
            for job, reason in _JOB_REASON.items()
        )
    ),
    "member_job_balance": _balance("m IN (0, 1, 2, 5)", "SUM(CASE WHEN code IN (0, 1, 2, 3) THEN 1 ELSE 0 END)"),
    "item_job_balance": _balance(
        "m IN (0, 5)", "SUM(CASE WHEN m NOT IN (1, 2) AND code IN (0, 2, 3) THEN 1 ELSE 0 END)"
    ),
    "cat_job_balance": _balance("m IN (0, 1, 2, 5) OR (m = 4 AND code = 0)", "SUM(CASE WHEN code = 0 THEN 1 ELSE 0 END)"),
    "province_job_balance": _balance("m IN (0, 1, 2, 3, 5)", "SUM(CASE WHEN code IN (0, 2, 3) THEN 1 ELSE 0 END)"),
    "once_item_total": _with(
        f"""
SELECT item_id, MAX(cat_id) AS category_id, MAX(brand_id) AS brand_id,
       CAST(CASE WHEN action = '0' THEN COUNT(*) ELSE 0 END AS INTEGER) AS item_click_count,
       CAST(CASE WHEN action = '2' THEN COUNT(*) ELSE 0 END AS INTEGER) AS item_sale_count,
       CAST(CASE WHEN action = '3' THEN COUNT(*) ELSE 0 END AS INTEGER) AS item_focus_count,
       {_bucket(3)} AS window_start, {_bucket(3)} + INTERVAL '3 hours' AS window_end
FROM (SELECT item_id, CASE WHEN event_id % 97 = 4 THEN NULL ELSE cat_id END AS cat_id, brand_id,
             CASE event_id % 97 WHEN 1 THEN NULL WHEN 2 THEN '' ELSE action END AS action, ts
      FROM ub WHERE event_id % 97 NOT IN (0, 5)) d
GROUP BY item_id, action, {_bucket(3)}"""
    ),
    "province_normalize": _with(f"SELECT event_id, {_NORM} AS province FROM ub"),
    "province_code": _with(
        f"SELECT n.event_id, n.province, COALESCE(rc.code, '') AS province_iso_3316_code"
        f" FROM (SELECT event_id, {_NORM} AS province FROM ub) n LEFT JOIN {_CODES} ON rc.province = n.province"
    ),
    "member_total": _with(_MEMBER),
    "item_total": _with(_ITEM),
    "cat_window": _with(_CAT),
    "province_window": _with(_PROVINCE),
    "member_running_total": _with(f"SELECT window_start, window_end, {_RUN} FROM ({_MEMBER}) m"),
    "member_grand_total": _with(
        f"SELECT {_cnt(0)} AS click_count, {_cnt(1)} AS addcart_count, {_cnt(2)} AS buy_count,"
        f" {_cnt(3)} AS focus_count FROM ub"
    ),
    "item_grand_total": _with(
        f"SELECT item_id, MAX(cat_id) AS cat_id, MAX(brand_id) AS brand_id, {_cnt(0)} AS item_click_count,"
        f" {_cnt(2)} AS item_sale_count, {_cnt(3)} AS item_focus_count FROM ub GROUP BY item_id"
    ),
}
_ORACLE["stream_csv_feed"] = _ORACLE["csv_feed"]


def _gate(job: str, size: int, slide: int, counted: str) -> str:
    """A job's messages in three batches by event id, ten days late at most behind the batches before."""
    return f"""
SELECT '{job}' AS job, COUNT(*) AS messages, CAST(SUM(CASE WHEN NOT bad AND NOT late THEN 1 ELSE 0 END) AS BIGINT) AS accepted,
       CAST(SUM(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS rejected,
       CAST(SUM(CASE WHEN NOT bad AND late THEN 1 ELSE 0 END) AS BIGINT) AS late,
       CAST(SUM(CASE WHEN NOT bad AND NOT late AND {counted} THEN 1 ELSE 0 END) AS BIGINT) AS counted
FROM (SELECT b.m, b.code, {_JOB_REASON[job].replace('event_id % 97', 'm')} IS NOT NULL AS bad,
             coalesce(b.us - b.us % {slide * 3_600_000_000} + {size * 3_600_000_000} <= w.latest - 864000000000, FALSE) AS late
      FROM batched b JOIN marks w ON w.part = b.part) j"""


_ORACLE["gate_balance"] = _with("SELECT 1").replace(
    "SELECT 1",
    f""", batched AS (
  SELECT event_id % 97 AS m, event_id % 3 AS part, action, {_ACODE} AS code, event_ms * 1000 AS us FROM ub
), marks AS (
  SELECT p.part, (SELECT MAX(us) FROM batched q WHERE q.part < p.part AND q.m NOT IN (0, 5)) AS latest
  FROM (SELECT DISTINCT part FROM batched) p
)"""
    + " UNION ALL ".join(
        (
            _gate("member_total", 3, 3, "code IN (0, 1, 2, 3)"),
            _gate("item_total", 3, 3, "m NOT IN (1, 2) AND code IN (0, 2, 3)"),
            _gate("cat_window", 60, 10, "code = 0"),
            _gate("province_window", 10, 10, "code IN (0, 2, 3)"),
        )
    ),
)
# Streaming twins (file replay, same metric functions) answer the same SQL.
for _name in (
    "member_total", "item_total", "cat_window", "province_window", "member_running_total", "member_grand_total", "item_grand_total",
):
    _ORACLE[f"stream_{_name}"] = _ORACLE[_name]


def oracle_sql() -> dict[str, str]:
    """For each key in ``queries()``, equivalent DuckDB SQL over the same parquet views."""
    keys = queries().keys()
    return {k: v for k, v in (_ORACLE | LLM_ORACLE).items() if k in keys}
