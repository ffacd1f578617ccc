"""Command line: run the dashboard jobs, or publish the CSV log as a feed.

    python -m clickpulse run  --source kafka --brokers host:9092 --sink jdbc --jdbc-url ... [--live]
    python -m clickpulse run  --source files --path dir --sink parquet --out dir --time event --once
    python -m clickpulse feed --csv user_log.csv --brokers host:9092 [--header]

``run`` starts J1-J4 in one session (one checkpoint folder per query under the
shared root) and waits; ``--once`` processes what is there, writes every window of it and stops.
"""

from __future__ import annotations

import argparse
import os
import sys
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession

from clickpulse.plans import jobs
from clickpulse.session import get_session
from clickpulse.sources import kafka, sinks


PASSWORD_VARIABLE = "CLICKPULSE_JDBC_PASSWORD"


def _messages(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.source == "kafka":
        return kafka.read_messages(spark, a.brokers, a.topic)
    # One JSON message per line in text files arriving in a folder.
    return spark.readStream.schema("value string").text(a.path)


def _password(a: argparse.Namespace) -> str | None:
    """Never from the command line, which every process of the machine can read."""
    if a.password_file:
        with open(a.password_file, encoding="utf-8") as f:
            return f.read().rstrip("\n")
    return os.environ.get(PASSWORD_VARIABLE)


def _writer(a: argparse.Namespace):
    def for_table(table: str):
        if a.sink == "console":
            return sinks.console(a.console_limit)
        if a.sink == "parquet":
            return sinks.parquet(f"{a.out.rstrip('/')}/{table}")
        # The job starters hand over a persisted batch (fan_out), as the JDBC sink wants.
        return sinks.JdbcTable(a.jdbc_url, table, a.user, _password(a), a.driver, num_partitions=a.jdbc_partitions)

    return for_table


def _settings(a: argparse.Namespace) -> jobs.JobSettings:
    given = {f.name: getattr(a, f.name) for f in fields(jobs.JobSettings) if getattr(a, f.name, None) is not None}
    if a.live:
        given["time"] = "clock"
    return jobs.JobSettings(**given)


def run(a: argparse.Namespace, spark: SparkSession | None = None) -> None:
    """Run the jobs; a job that fails is started again on its own, and the others go on."""
    spark = spark or get_session("clickpulse-dashboards")
    msgs, settings, writer = _messages(spark, a), _settings(a), _writer(a)
    if a.once:
        jobs.run_once(msgs, writer, settings, a.checkpoint_root, a.jobs)
        return
    rejects = (lambda job: sinks.parquet(f"{a.rejects.rstrip('/')}/{job}")) if a.rejects else None
    errors = jobs.start_dashboards(msgs, writer, settings, rejects, a.checkpoint_root, a.jobs).wait()
    if errors:
        raise SystemExit("\n".join(f"{name}: {e}" for name, e in errors.items()))


def feed(a: argparse.Namespace, spark: SparkSession | None = None) -> None:
    """The CSV log as keyless JSON messages on the topic."""
    from clickpulse.sources.userlog import read_user_log

    spark = spark or get_session("clickpulse-feed")
    kafka.write_messages(read_user_log(spark, a.csv, header=a.header), a.brokers, a.topic)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clickpulse")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="run the dashboard jobs")
    r.add_argument("--source", choices=["kafka", "files"], default="kafka")
    r.add_argument("--brokers")
    r.add_argument("--topic", default=kafka.DEFAULT_TOPIC)
    r.add_argument("--path", help="folder of JSON-line files (source files)")
    r.add_argument("--sink", choices=["console", "parquet", "jdbc"], default="console")
    r.add_argument("--out", help="output folder (sink parquet)")
    r.add_argument("--jdbc-url")
    r.add_argument("--user")
    r.add_argument("--password-file", help=f"file with the database password (default: the variable {PASSWORD_VARIABLE})")
    r.add_argument("--driver")
    r.add_argument("--jdbc-partitions", type=int, default=8)
    r.add_argument("--jobs", type=lambda s: s.split(","), help="subset, e.g. member_total,cat_window")
    r.add_argument("--console-limit", type=int, default=1000, help="rows printed of each batch; the rest is counted")
    r.add_argument("--rejects", help="folder for the messages that each job cannot use")
    r.add_argument("--live", action="store_true", help="windows close by the clock (T7)")
    r.add_argument("--once", action="store_true", help="process available input, then stop")
    r.add_argument("--checkpoint-root", help="folder of the queries' checkpoints (default: under spark.checkpoint.dir)")
    for f in fields(jobs.JobSettings):
        if f.name != "strict":
            r.add_argument("--" + f.name.replace("_", "-"), dest=f.name)
    r.add_argument("--strict", action="store_true", default=None, help="fail on a bad message")
    fd = sub.add_parser("feed", help="publish the CSV user log as JSON messages")
    fd.add_argument("--csv", required=True)
    fd.add_argument("--brokers", required=True)
    fd.add_argument("--topic", default=kafka.DEFAULT_TOPIC)
    fd.add_argument("--header", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    a = parser().parse_args(argv)
    return run(a, spark) if a.command == "run" else feed(a, spark)


if __name__ == "__main__":
    main(sys.argv[1:])
