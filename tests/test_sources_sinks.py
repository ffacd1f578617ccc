"""CSV user log (S3), Kafka options (S1/S4), sinks."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clickpulse.schema import EVENT_COLUMNS
from clickpulse.sources import sinks
from clickpulse.sources.kafka import kafka_sink_options, kafka_source_options, read_messages
from clickpulse.sources.userlog import read_user_log


def write_lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/log.csv", "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_csv_positions_trailing_comma_and_short_rows(spark, scratch):
    path = scratch("csv")
    write_lines(
        path,
        [
            "328862,323294,833,2882,2661,08,29,0,0,1,内蒙古,",
            '1,2,3,4,5,6,7,2,8,0,上海市',
            "9,9,9",
        ],
    )
    rows = read_user_log(spark, path).orderBy("user_id").collect()
    assert [r.user_id for r in rows] == ["1", "328862", "9"]
    r = rows[1]
    assert (r.item_id, r.cat_id, r.brand_id, r.action, r.age_range, r.gender, r.province) == (
        "323294", "833", "2661", "0", "0", "1", "内蒙古",
    )
    assert rows[2].action is None and rows[2].province is None
    assert read_user_log(spark, path).columns == EVENT_COLUMNS
    assert rows[0].event_ms > 1_600_000_000_000


def test_csv_header_and_quotes_are_data(spark, scratch):
    path = scratch("csv_h")
    write_lines(path, [",".join(["h"] * 11), 'u,"i,c,m,b,1,2,3,a,g,p'])
    rows = read_user_log(spark, path, header=True).collect()
    assert len(rows) == 1 and rows[0].item_id == '"i' and rows[0].action == "3"


def test_kafka_options():
    o = kafka_source_options("b:9092", maxOffsetsPerTrigger="1000", **{"security.protocol": "SSL"})
    assert o == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "realtime-data",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
        "kafka.security.protocol": "SSL",
    }
    assert kafka_sink_options("b:9092", "t") == {"kafka.bootstrap.servers": "b:9092", "topic": "t"}


def test_kafka_connector_absent_is_reported(spark):
    try:
        read_messages(spark, "localhost:1")
    except PySparkException as e:
        assert "kafka" in str(e).lower()
    else:  # pragma: no cover - only where the connector jar is installed
        pytest.skip("Kafka connector present")


def metric_rows(spark):
    return spark.createDataFrame(
        [("上海", "CN-31", 3, 1, 2)], "province string, province_iso_3316_code string, click_count long, "
        "focus_count long, buy_count long"
    ).withColumn("window_start", F.current_timestamp().cast("timestamp_ntz"))


def test_sink_rows_shape_and_types(spark):
    out = sinks.sink_rows(metric_rows(spark), "realtime_province_window", batch_id=7)
    assert out.columns == sinks.SINK_TABLES["realtime_province_window"][0] + ["window_start", "batch_id"]
    types = dict(out.dtypes)
    assert types["click_count"] == "int" and types["time"] == "timestamp" and types["batch_id"] == "bigint"
    item = spark.createDataFrame([("i", "c", "b", 1, 0, 0)], "item_id string, cat_id string, brand_id string, "
                                 "item_click_count long, item_sale_count long, item_focus_count long")
    assert sinks.sink_rows(item, "realtime_item_total").columns[:3] == ["item_id", "category_id", "brand_id"]


def test_sink_int_overflow_fails(spark):
    df = metric_rows(spark).withColumn("click_count", F.lit(2**31))
    with pytest.raises(PySparkException):
        sinks.sink_rows(df, "realtime_province_window").collect()


class Crash(Exception):
    pass


class TablesInMemory(sinks.JdbcTable):
    """The sink against tables that this test keeps: statements are applied to a copy, which replaces the tables on commit.

    ``look`` is called before and after every step that a reader could fall between; ``fail`` names the step
    that breaks off.
    """

    def __init__(self, look=None, fail=None):
        super().__init__("jdbc:none", "realtime_province_window", user="u", password="p")
        self.tables = {self.table: [], self.staging: [], self.ledger: []}
        self.look, self.fail, self.steps = look or (lambda: None), fail, 0

    def _step(self):
        self.steps += 1
        if self.steps == self.fail:
            raise Crash
        self.look()

    def transact(self, spark, statements, query, batch_id):
        self._step()
        work = {name: list(rows) for name, rows in self.tables.items()}
        own = {"query_id": query, "batch_id": batch_id}
        mine = lambda r: all(r[k] == v for k, v in own.items())
        for statement in statements:
            self._step()
            assert statement.count("?") == 2
            if m := re.fullmatch(r"DELETE FROM (\S+) WHERE query_id = \? AND batch_id = \?", statement):
                work[m[1]] = [r for r in work[m[1]] if not mine(r)]
            elif m := re.fullmatch(r"INSERT INTO (\S+) \(([^)]*)\) SELECT ([^()]*) FROM (\S+) WHERE .*", statement):
                assert m[2] == m[3]
                work[m[1]] += [{c: r[c] for c in m[2].split(", ")} for r in work[m[4]] if mine(r)]
            elif m := re.fullmatch(r"INSERT INTO (\S+) .* SELECT query_id, batch_id, COUNT\(\*\).* FROM (\S+) WHERE .*", statement):
                count = sum(map(mine, work[m[2]]))
                work[m[1]] += [own | {"row_count": count}] * bool(count)
            else:
                raise AssertionError(statement)
        self._step()
        self.tables = work  # commit
        self._step()

    def stage(self, rows):
        self._step()
        for row in rows.collect():  # a failure may leave a part of the rows
            self.tables[self.staging].append(row.asDict())
            self._step()

    def rows(self, query, batch_id):
        return sorted(
            str(r["province"]) for r in self.tables[self.table] if (r["query_id"], r["batch_id"]) == (query, batch_id)
        )


def provinces(spark, *names):
    one = metric_rows(spark).drop("province")
    rows = spark.createDataFrame([(n,) for n in names], "province string").join(one)
    return sinks.sink_rows(rows, "realtime_province_window")


def test_jdbc_batches_replace_themselves(spark):
    w = TablesInMemory()
    with sinks.writing_as("q1"):
        w(provinces(spark, "a", "b"), 3)
        w(provinces(spark, "c"), 3)  # the batch runs again
        w(provinces(spark, "d"), 4)
    with sinks.writing_as("q2"):
        w(provinces(spark, "e"), 3)  # another checkpoint: its own rows
    assert (w.rows("q1", 3), w.rows("q1", 4), w.rows("q2", 3)) == (["c"], ["d"], ["e"])
    ledger = {(r["query_id"], r["batch_id"]): r["row_count"] for r in w.tables[w.ledger]}
    assert ledger == {("q1", 3): 1, ("q1", 4): 1, ("q2", 3): 1} and not w.tables[w.staging]
    assert w.props["batchsize"] == "100" and w.props["numPartitions"] == "8"


def test_jdbc_readers_see_the_old_or_the_new_batch(spark):
    seen = []
    w = TablesInMemory(look=lambda: seen.append(w.rows("q", 1)))
    with sinks.writing_as("q"):
        w(provinces(spark, "a", "b"), 1)
        assert seen[0] == [] and set(map(tuple, seen)) == {(), ("a", "b")}
        seen.clear()
        w(provinces(spark, "c", "d", "e"), 1)
    assert set(map(tuple, seen)) == {("a", "b"), ("c", "d", "e")} and len(seen) > 12
    assert seen == sorted(seen)  # from the old one to the new one, once


def test_jdbc_failure_at_any_step_leaves_the_old_batch(spark):
    old, new = (provinces(spark, *names).coalesce(1).persist() for names in ("a", ("b", "c")))
    steps = 0
    for fail in range(1, 30):
        w = TablesInMemory()
        with sinks.writing_as("q"):
            w(old, 1)
            w.steps, w.fail = 0, fail
            try:
                w(new, 1)
            except Crash:
                steps += 1
                committed = w.rows("q", 1)
                assert committed in (["a"], ["b", "c"])
                assert {r["row_count"] for r in w.tables[w.ledger]} == {len(committed)}
            w.fail = None
            w(new, 1)  # the restart runs the batch again
        assert w.rows("q", 1) == ["b", "c"] and not w.tables[w.staging]
    assert steps > 12


def test_jdbc_empty_batch_and_ddl(spark):
    w = TablesInMemory()
    with sinks.writing_as("q"):
        w(provinces(spark, "a"), 1)
        w(provinces(spark, "a").limit(0), 1)
    assert w.rows("q", 1) == [] and w.tables[w.ledger] == []
    ddl = w.create_statements(provinces(spark, "a"))
    assert len(ddl) == 5 and "click_count INTEGER" in ddl[0] and "window_start TIMESTAMP" in ddl[0]
    assert ddl[4].startswith("CREATE TABLE realtime_province_window_batches (query_id VARCHAR(64) NOT NULL")



def test_parquet_sink_rewrites_replayed_batch(spark, scratch):
    path = scratch("pq")
    w = sinks.parquet(path)
    df = metric_rows(spark)
    w(df, 0)
    w(df, 0)
    w(df, 1)
    assert spark.read.parquet(path).count() == 2


def test_two_checkpoints_keep_all_their_rows(spark, scratch):
    src, out = scratch("two_src"), scratch("two_out")
    spark.range(4).write.parquet(src)
    for ckpt in (scratch("ckpt_a"), scratch("ckpt_b")):
        for _ in range(2):  # a restart from the same checkpoint adds nothing
            q = spark.readStream.schema("id long").parquet(src).writeStream.foreachBatch(sinks.parquet(out))
            q.option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 8 and rows.select("query_id").distinct().count() == 2
    assert {r.batch_id for r in rows.collect()} == {0}
    assert "none" not in {r.query_id for r in rows.collect()}


def test_console_prints_all_rows_or_says_how_many_are_left(spark, capsys):
    sinks.console()(spark.range(57), 0)
    out = capsys.readouterr().out
    assert all(f"id={k}\n" in out for k in range(57)) and "not shown" not in out
    sinks.console(limit=20)(spark.range(57), 0)
    out = capsys.readouterr().out
    assert out.count("id=") == 20 and "37 more rows not shown" in out


def test_csv_empty_fields_are_empty_texts(spark, scratch):
    path = scratch("csv_empty")
    write_lines(path, ["1,2,,4,5,08,29,0,7,1,", "1,2,3,4,5,08,29,,7,1,北京市,,"])
    rows = read_user_log(spark, path).collect()
    assert {(r.cat_id, r.action, r.province) for r in rows} == {("", "0", ""), ("3", "", "北京市")}


def test_fan_out_sends_one_batch_to_every_sink(spark, scratch, capsys):
    path = scratch("fan")
    got = []
    w = sinks.fan_out(sinks.console(5), sinks.parquet(path), lambda b, i: got.append(b.count()),
                      shape=lambda b, i: sinks.sink_rows(b, "realtime_province_window"))
    w(metric_rows(spark), 4)
    assert got == [1] and spark.read.parquet(path).count() == 1
    assert "CN-31" in capsys.readouterr().out


def test_kafka_batch_write_reports_missing_connector(spark):
    from clickpulse.sources.kafka import write_messages

    df = spark.createDataFrame([tuple(["x"] * 9) + (1,)], ", ".join(
        f"{c} {'bigint' if c == 'event_ms' else 'string'}" for c in EVENT_COLUMNS))
    try:
        write_messages(df, "localhost:1", "t")
    except PySparkException as e:
        assert "kafka" in str(e).lower()
    else:  # pragma: no cover - only where the connector jar is installed
        pytest.skip("Kafka connector present")
