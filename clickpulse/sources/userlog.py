"""S3: the positional CSV user log, batch or streaming.

UTF-8, comma-separated, no quoting, 11 text columns; ``month`` and ``day`` are
dropped. Empty fields are empty texts. Fields that a short row does not have are null, which
makes it a reject of the readers that need them; extra trailing fields, such as a trailing comma, are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.schema import EVENT_COLUMNS, USER_LOG_COLUMNS

_UNUSED = ("month", "day")


def read_user_log(spark: SparkSession, path: str, header: bool = False, streaming: bool = False) -> DataFrame:
    """Rows of the log as event columns; ``event_ms`` is the load time.

    The load time is one value per query (per micro-batch when streaming): it
    says when the row was read, not when the behaviour happened, so never
    window on it. ``header`` leaves out the first line of each file.
    """
    # Whole lines, by a separator that no text holds: the CSV reader takes empty fields for nulls.
    options = {"header": str(header).lower(), "encoding": "UTF-8", "sep": "\x01", "quote": "", "mode": "PERMISSIVE"}
    lines = (spark.readStream if streaming else spark.read).schema("value string").options(**options).csv(path)
    fields = F.split("value", ",", -1)
    kept = [F.get(fields, F.lit(i)).alias(c) for i, c in enumerate(USER_LOG_COLUMNS) if c not in _UNUSED]
    return lines.select(*kept, F.unix_millis(F.current_timestamp()).alias("event_ms")).select(*EVENT_COLUMNS)


def to_user_log_lines(df: DataFrame) -> DataFrame:
    """The inverse, as text lines (``value``), with empty ``month`` and ``day``."""
    cols = [F.lit("") if c in _UNUSED else F.coalesce(F.col(c), F.lit("")) for c in USER_LOG_COLUMNS]
    return df.select(F.concat_ws(",", *cols).alias("value"))
