"""Jobs from the command line, for spark-submit.

    clean    raw results (CSV) to the two cleaned tables, in files and in a database
    ask      one question, or all, of the cleaned tables
    live     one measure as a stream, from a topic to topic, table and files
    archive  messages of some topics as a stream, to a folder for each
    total    climb totals as a stream, from the table of climbed windows
    latest   the latest total
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.functions.telemetry import from_messages
from paceline.operators.clean import (
    both_limits,
    conform,
    normalise_names,
    with_dense_id,
)
from paceline.plans import history, improvement, live, questions
from paceline.schemas import DISTANCE_LIMITED, LIVE_TABLES, RESULTS, TIME_LIMITED
from paceline.session import build_session
from paceline.sources.files import read_results, read_table, stream_topics, write_table
from paceline.sources.jdbc import Database
from paceline.sources.kafka import stream_kafka
from paceline.streaming.jobs import archive, drain, run_forever, stream_session
from paceline.streaming.measures import measures
from paceline.streaming.sinks import fan_out, to_target
from paceline.streaming.state import StateTable, TotalsTarget

RESULTS_TABLE = "results"
TIME_TABLE = "running_time_constrained"
DISTANCE_TABLE = "running_distance_constrained"

# Questions by number: the tables each needs, and the plan.
QUESTIONS = {
    1: ("d", questions.fastest_events),
    2: ("d", questions.athletes_per_band),
    3: ("d", questions.speed_by_band_and_age),
    4: ("d", questions.most_attended_events),
    5: ("d", questions.fastest_countries),
    6: ("td", questions.athletes_per_country),
    7: ("td", questions.athletes_per_age_group),
    8: ("t", questions.distance_per_decade),
    9: ("d", improvement.most_improved),
    10: ("d", questions.speed_by_gender),
}


def clean(spark: SparkSession, source: str, tables: str) -> None:
    """Both tables in one file, apart by a partition for each kind; the file is read once to count and once to clean."""
    raw = normalise_names(read_results(spark, source))
    write_table(conform(with_dense_id(both_limits(raw)), RESULTS), f"{tables}/{RESULTS_TABLE}", partition_by="kind")


def cleaned(spark: SparkSession, tables: str, kind: str) -> DataFrame:
    """The table of one kind, ``time`` or ``distance``; only its partition and the columns asked for are read."""
    results = read_table(spark, f"{tables}/{RESULTS_TABLE}", RESULTS).filter(F.col("kind") == kind)
    return conform(results, TIME_LIMITED if kind == "time" else DISTANCE_LIMITED)


def export(spark: SparkSession, tables: str, database: Database, connections: int) -> None:
    """Both tables to a database, in place of what is there, each with ids of its own from 0 on, by which it can be
    read in even ranges."""
    for kind, name in (("time", TIME_TABLE), ("distance", DISTANCE_TABLE)):
        rows = with_dense_id(cleaned(spark, tables, kind).drop("id"))
        database.overwrite(conform(rows, TIME_LIMITED if kind == "time" else DISTANCE_LIMITED), name, connections)


def ask(spark: SparkSession, tables: str, number: int) -> DataFrame:
    needed, plan = QUESTIONS[number]
    return plan(*[cleaned(spark, tables, {"t": "time", "d": "distance"}[name]) for name in needed])


def past_races(spark: SparkSession, args: argparse.Namespace, database: Database | None) -> DataFrame | None:
    """Distance-limited results for the finish estimate: from stored tables, or from the database in parallel
    ranges of its row ids."""
    if args.tables:
        return cleaned(spark, args.tables, "distance")
    if database and args.history_rows:
        return database.read(spark, DISTANCE_TABLE, "id", 0, args.history_rows, args.connections)
    return None


def live_stream(spark: SparkSession, args: argparse.Namespace):
    """The writer of one measure, from its topic to its targets."""
    database = Database(args.jdbc, dict(p.split("=", 1) for p in args.jdbc_property)) if args.jdbc else None
    past, races = None, past_races(spark, args, database)
    if races is not None:
        write_table(history.weighted_history(races, args.length_km, args.year), f"{args.checkpoint}/history")
        past = read_table(spark, f"{args.checkpoint}/history")
    measure = measures(past, args.length_km, args.salts)[args.measure]
    topic = (measure.source if args.from_topic else None) or args.topic
    messages = topic_messages(spark, args, [topic])
    published = measure.from_source(messages) if args.from_topic else measure.published(from_messages(messages))
    target = fan_out(*measure.targets(args.servers, database, args.files))
    return to_target(published, target, f"{args.checkpoint}/stream")


def topic_messages(spark: SparkSession, args: argparse.Namespace, topics: list[str]) -> DataFrame:
    """Messages of some topics: from brokers, or from a topic log of files."""
    if args.servers:
        return stream_kafka(spark, args.servers, topics, args.starting, args.per_batch)
    return stream_topics(spark, args.log, topics, args.per_batch)


def totals_table(path: str) -> StateTable:
    return StateTable(path, LIVE_TABLES["elev_gain_total"], ("runner_id",))


def total_stream(spark: SparkSession, args: argparse.Namespace):
    """Climbed windows, each once however often the stream before wrote it: the last total per runner, or with
    ``--per-row`` a total after each window."""
    climbs = live.once(spark.readStream.schema(LIVE_TABLES["altitude_gain"]).parquet(args.climbs))
    if args.per_row:
        return to_target(climbs, TotalsTarget(args.totals), args.checkpoint)
    return to_target(live.climb_totals(climbs), totals_table(args.totals), args.checkpoint, "update")


def latest_value(spark: SparkSession, totals: str) -> str:
    """The latest total as a line of text."""
    row = live.latest(totals_table(totals).read(spark)).first()
    return "no value yet" if row is None else f"{row.time:%Y-%m-%d %H:%M:%S} runner {row.runner_id}: {row.value} m"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="paceline", description=__doc__,
                                  formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = top.add_subparsers(dest="job", required=True)

    def database(job):
        job.add_argument("--jdbc", help="URL of the database")
        job.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE")
        job.add_argument("--connections", type=int, default=32)

    def stream(job):
        job.add_argument("--state-partitions", type=int, help="tasks of a batch, kept by the checkpoint for good")
        job.add_argument("--once", action="store_true", help="process what is there and end")

    def topics(job):
        job.add_argument("--servers", help="brokers")
        job.add_argument("--log", help="folder of a topic log, in place of brokers")
        job.add_argument("--starting", default="latest", help="first offsets: latest or earliest")
        job.add_argument("--per-batch", type=int, help="most messages (or files of a log) in a batch")

    job = jobs.add_parser("clean")
    job.add_argument("source")
    job.add_argument("tables")
    database(job)
    job = jobs.add_parser("ask")
    job.add_argument("tables")
    job.add_argument("answers", help="folder for the answers")
    job.add_argument("--question", type=int, choices=sorted(QUESTIONS))
    job = jobs.add_parser("live")
    job.add_argument("measure")
    job.add_argument("checkpoint")
    job.add_argument("--topic", default="run_stats")
    job.add_argument("--from-topic", action="store_true", help="start from the topic of the measure before")
    job.add_argument("--files", help="folder for files of messages, or of the table")
    job.add_argument("--tables", help="cleaned tables, for the finish estimate")
    job.add_argument("--history-rows", type=int, help="row ids in the database's table, for the finish estimate")
    job.add_argument("--year", type=int, default=2022)
    job.add_argument("--length-km", type=int, default=21)
    job.add_argument("--salts", type=int, default=8, help="tasks that share a busy runner's history")
    topics(job)
    stream(job)
    database(job)
    job = jobs.add_parser("archive")
    job.add_argument("archive", help="folder with a folder for each topic")
    job.add_argument("checkpoint")
    job.add_argument("topics", nargs="+")
    topics(job)
    stream(job)
    job.set_defaults(starting="earliest")
    job = jobs.add_parser("total")
    job.add_argument("climbs", help="folder of the altitude_gain table")
    job.add_argument("totals", help="folder for the totals")
    job.add_argument("--per-row", action="store_true", help="a total after each window, not only the last")
    job.add_argument("checkpoint")
    stream(job)
    job = jobs.add_parser("latest")
    job.add_argument("totals")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "clean":
        clean(spark, args.source, args.tables)
        if args.jdbc:
            properties = dict(p.split("=", 1) for p in args.jdbc_property)
            export(spark, args.tables, Database(args.jdbc, properties), args.connections)
    elif args.job == "ask":
        for number in [args.question] if args.question else sorted(QUESTIONS):
            write_table(ask(spark, args.tables, number), f"{args.answers}/question_{number}")
    elif args.job == "latest":
        print(latest_value(spark, args.totals))
    else:
        session = stream_session(spark, args.state_partitions)
        if args.job == "live":
            writer = live_stream(session, args)
        elif args.job == "archive":
            writer = archive(topic_messages(session, args, args.topics), args.archive, args.checkpoint)
        else:
            writer = total_stream(session, args)
        if args.once:
            drain(writer)
        else:
            run_forever(session, writer)


def main() -> None:
    args = parser().parse_args()
    run(build_session(), args)


if __name__ == "__main__":
    main()
