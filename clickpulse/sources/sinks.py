"""S5-S7 sinks, with the write-time stamp (P16) and sink column types.

Each dashboard job writes through one ``foreachBatch`` function; ``fan_out``
sends one persisted micro-batch to several sinks (console and database) so the
source is read once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.schema import CAT_WINDOW_COLUMNS, ITEM_TOTAL_COLUMNS, MEMBER_TOTAL_COLUMNS, PROVINCE_WINDOW_COLUMNS

BatchWriter = Callable[[DataFrame, int], Any]

# Result table names -> (columns in sink order, renames from metric columns).
SINK_TABLES: dict[str, tuple[list[str], dict[str, str]]] = {
    "realtime_member_total": (MEMBER_TOTAL_COLUMNS, {}),
    "realtime_item_total": (ITEM_TOTAL_COLUMNS, {"cat_id": "category_id"}),
    "realtime_cat_window": (CAT_WINDOW_COLUMNS, {}),
    "realtime_province_window": (PROVINCE_WINDOW_COLUMNS, {}),
}
WINDOW_COLUMNS = ["window_start", "window_end"]
BATCH_KEY = ["query_id", "batch_id"]


def sink_rows(df: DataFrame, table: str, batch_id: int | None = None) -> DataFrame:
    """Metric rows shaped for ``table``: renamed, counts as INT, ``time`` = now.

    The window bounds and the batch id are kept after the reference columns;
    without them a stored row cannot be tied to its window or replayed safely.
    The INT cast is ANSI: a count past 2^31-1 fails the batch instead of wrapping.
    """
    columns, renames = SINK_TABLES[table]
    df = df.withColumnsRenamed(renames).withColumn("time", F.current_timestamp())
    out = [F.col(c).cast("int").alias(c) if c.endswith("_count") else F.col(c) for c in columns]
    extra = [c for c in WINDOW_COLUMNS if c in df.columns]
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        extra.append("batch_id")
    return df.select(*out, *extra)


# Which query a batch belongs to. Batch ids start at 0 with every checkpoint, so rows are keyed by
# the id that the checkpoint gives its query as well: a replayed batch replaces
# itself, and never another run's rows.
_writing: ContextVar[str | None] = ContextVar("writing", default=None)
NO_QUERY = "none"


@contextmanager
def writing_as(query_id: str) -> Iterator[None]:
    """Name the query for batches that are written outside of ``foreachBatch``."""
    token = _writing.set(query_id)
    try:
        yield
    finally:
        _writing.reset(token)


def query_id(batch: DataFrame) -> str:
    """The id, kept in the checkpoint, of the query that this batch belongs to."""
    return _writing.get() or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or NO_QUERY


def console(limit: int = 1000) -> BatchWriter:
    """Print the rows of each batch, and how many there are beyond ``limit``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.limit(limit + 1).collect()
        print(f"-- batch {batch_id}")
        for row in rows[:limit]:
            print(", ".join(f"{c}={row[c]}" for c in batch.columns))
        if len(rows) > limit:
            print(f"-- {batch.count() - limit} more rows not shown")

    return write


def parquet(path: str, partition_by: Sequence[str] = ()) -> BatchWriter:
    """S7 inside ``foreachBatch``: each batch to ``path/query_id=<id>/batch_id=<n>``, overwritten on retry."""

    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{path.rstrip('/')}/query_id={query_id(batch)}/batch_id={batch_id}")

    return write


def parquet_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    trigger: str = "1 second",
    available_now: bool = False,
):
    """S7 as Spark's own file sink: append mode, exactly once through its commit log.

    For metric streams with a watermark (each window written once, when it
    closes). Readers should read ``path`` with Spark, which honours the log.
    """
    w = df.writeStream.format("parquet").outputMode("append").option("path", path)
    w = w.option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


class JdbcTable:
    """Each micro-batch to a JDBC table, whole and once per ``(query_id, batch_id)``.

    Rows go to a staging table first, in parallel: Spark's JDBC writer, ``batchsize`` rows per
    statement batch, at most ``num_partitions`` connections. Then one transaction on the
    driver removes the batch from the table, moves the staged rows over and enters the batch in the ledger. Readers of
    the table see the batch as it was before or as it is now, never without it; a failure at any point
    leaves the table as it was, and the batch runs again: it clears what an earlier attempt has staged and
    replaces itself, never another query's rows.

    The ledger has a row per batch: who wrote it, when, how many rows. ``create_statements`` gives the
    three tables, with the index that finds a batch without a scan. All names may carry a schema.

    At most ``num_partitions`` tasks write at once, so a batch coming out of a shuffle with
    thousands of partitions still opens only that many connections. Use it behind
    ``fan_out``, which persists the batch, so the cap narrows only the write, not the
    aggregation before it.
    """

    def __init__(
        self,
        url: str,
        table: str,
        user: str | None = None,
        password: str | None = None,
        driver: str | None = None,
        batch_size: int = 100,
        num_partitions: int = 8,
    ) -> None:
        self.url, self.table = url, table
        self.staging, self.ledger = f"{table}_staging", f"{table}_batches"
        self.props = {k: v for k, v in {"user": user, "password": password, "driver": driver}.items() if v}
        self.props["batchsize"] = str(batch_size)
        self.props["numPartitions"] = str(num_partitions)

    def create_statements(self, rows: DataFrame) -> list[str]:
        """DDL of the table for such rows, its staging table, its ledger, and the indexes on batches."""
        kinds = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR(255)", "double": "DOUBLE PRECISION"}
        columns = [f"{c} {kinds.get(t, 'TIMESTAMP')}" for c, t in rows.dtypes if c not in BATCH_KEY]
        key = ["query_id VARCHAR(64) NOT NULL", "batch_id BIGINT NOT NULL"]
        out = []
        for table in (self.table, self.staging):
            out.append(f"CREATE TABLE {table} ({', '.join([*columns, *key])})")
            out.append(f"CREATE INDEX {table.replace('.', '_')}_batch ON {table} (query_id, batch_id)")
        more = [*key, "row_count BIGINT NOT NULL", "committed TIMESTAMP NOT NULL", "PRIMARY KEY (query_id, batch_id)"]
        return [*out, f"CREATE TABLE {self.ledger} ({', '.join(more)})"]

    def clear_statements(self) -> list[str]:
        """What removes rows that an earlier attempt of the batch has staged."""
        return [f"DELETE FROM {self.staging} WHERE query_id = ? AND batch_id = ?"]

    def swap_statements(self, columns: Sequence[str]) -> list[str]:
        """The one transaction that puts the staged batch in place; each statement takes the query and the batch."""
        batch, names = "WHERE query_id = ? AND batch_id = ?", ", ".join(columns)
        counted = f"SELECT query_id, batch_id, COUNT(*), CURRENT_TIMESTAMP FROM {self.staging} {batch} GROUP BY query_id, batch_id"
        return [
            f"DELETE FROM {self.table} {batch}",
            f"INSERT INTO {self.table} ({names}) SELECT {names} FROM {self.staging} {batch}",
            f"DELETE FROM {self.ledger} {batch}",
            f"INSERT INTO {self.ledger} (query_id, batch_id, row_count, committed) {counted}",
            f"DELETE FROM {self.staging} {batch}",
        ]

    def transact(self, spark, statements: Sequence[str], query: str, batch_id: int) -> None:
        """Run the statements for a batch in one transaction, on the driver, over the JVM's JDBC driver."""
        jvm = spark.sparkContext._jvm  # noqa: SLF001 - the JVM's JDBC driver manager
        props = jvm.java.util.Properties()
        for k in ("user", "password"):
            if k in self.props:
                props.setProperty(k, self.props[k])
        if "driver" in self.props:
            jvm.java.lang.Class.forName(self.props["driver"])
        conn = jvm.java.sql.DriverManager.getConnection(self.url, props)
        try:
            conn.setAutoCommit(False)
            try:
                for statement in statements:
                    st = conn.prepareStatement(statement)
                    st.setString(1, query)
                    st.setLong(2, batch_id)
                    st.executeUpdate()
                    st.close()
                conn.commit()
            except Exception:
                conn.rollback()
                raise
        finally:
            conn.close()

    def stage(self, rows: DataFrame) -> None:
        rows.write.jdbc(self.url, self.staging, mode="append", properties=self.props)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        query, spark = query_id(batch), batch.sparkSession
        rows = batch.withColumns({"query_id": F.lit(query), "batch_id": F.lit(batch_id).cast("bigint")})
        self.transact(spark, self.clear_statements(), query, batch_id)
        self.stage(rows)
        self.transact(spark, self.swap_statements(rows.columns), query, batch_id)


def fan_out(*writers: BatchWriter, shape: Callable[[DataFrame, int], DataFrame] | None = None) -> BatchWriter:
    """One ``foreachBatch`` function writing the same batch to every writer.

    The batch is persisted once, so two sinks do not compute it twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch, batch_id) if shape else batch
        rows.persist()
        try:
            for w in writers:
                w(rows, batch_id)
        finally:
            rows.unpersist()

    return write
