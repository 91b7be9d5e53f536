"""Whole jobs: cleaning and asking from a file, and every measure to its targets."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from paceline import __main__ as cli
from paceline import fixtures
from paceline.plans import live, questions
from paceline.functions.telemetry import to_messages
from paceline.operators.clean import both_limits, conform, distance_limited, normalise_names, time_limited
from paceline.schemas import DISTANCE_LIMITED, RAW_HEADERS, TIME_LIMITED
from paceline.session import shared_path
from paceline.sources.files import read_results, write_topics
from paceline.sources.jdbc import Database
from paceline.streaming import jobs, sinks
from paceline.streaming.measures import measures

SF = "/root/testdata/sf0.001"


def test_clean_and_ask(spark):
    path = shared_path(spark, "job")
    raw = fixtures.race_results_raw(spark, SF)
    raw.toDF(*RAW_HEADERS).write.csv(f"{path}/csv", header=True)
    cli.clean(spark, f"{path}/csv", path)
    timed, distance = (cli.cleaned(spark, path, kind) for kind in ("time", "distance"))
    assert (timed.schema, distance.schema) == (TIME_LIMITED, DISTANCE_LIMITED)
    assert (timed.count(), distance.count()) == (1681, 4232)
    assert distance.select("id").distinct().count() == 4232
    direct = questions.speed_by_gender(fixtures.distance_results(spark, SF))
    assert cli.ask(spark, path, 10).collect() == direct.collect()
    assert cli.ask(spark, path, 7).count() == 3
    assert cli.ask(spark, path, 8).count() == 2


def test_cleaning_reads_the_file_once(spark):
    path = shared_path(spark, "once")
    raw = fixtures.race_results_raw(spark, SF)
    raw.toDF(*RAW_HEADERS).write.csv(f"{path}/csv", header=True)
    both = both_limits(normalise_names(read_results(spark, f"{path}/csv")))
    assert both._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    for kind, make, schema in (("time", time_limited, TIME_LIMITED), ("distance", distance_limited, DISTANCE_LIMITED)):
        columns = [c for c in schema.names if c != "id"]
        one = conform(both.filter(F.col("kind") == kind).withColumn("id", F.lit(0)), schema).select(columns)
        apart = conform(make(raw).withColumn("id", F.lit(0)), schema).select(columns)
        assert one.exceptAll(apart).isEmpty() and apart.exceptAll(one).isEmpty()


def command(spark, *words):
    cli.run(spark, cli.parser().parse_args([str(w) for w in words]))


def test_jobs_in_a_row(spark, capsys):
    root = shared_path(spark, "jobs")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    telemetry = fixtures.telemetry(spark, SF)
    write_topics(to_messages(telemetry).select(F.lit("run_stats").alias("topic"), "key", "value"), f"{root}/log")
    once = ["--once", "--state-partitions", 3]
    command(spark, "live", "elevation", f"{root}/c1", "--log", f"{root}/log", "--files", f"{root}/out", *once)
    for run in (1, 2):
        command(spark, "total", f"{root}/out/altitude_gain", f"{root}/totals", f"{root}/c2", *once)
    capsys.readouterr()
    command(spark, "latest", f"{root}/totals")
    printed = capsys.readouterr().out
    windows = spark.read.parquet(f"{root}/out/altitude_gain")
    best = live.latest(live.climb_totals(windows)).first()
    assert printed.strip().endswith(f"runner {best.runner_id}: {best.value} m")
    command(spark, "archive", f"{root}/archive", f"{root}/c3", "run_stats", "--log", f"{root}/log", *once)
    assert spark.read.parquet(f"{root}/archive").count() == telemetry.count()
    command(spark, "live", "speed", f"{root}/c4", "--log", f"{root}/log", "--files", f"{root}/out", *once)
    speeds = spark.read.schema("value string, batch int").options(**sinks.CSV).csv(f"{root}/out/speed")
    assert speeds.count() == telemetry.count()


def test_latest_of_nothing(spark):
    path = shared_path(spark, "none")
    assert cli.latest_value(spark, path) == "no value yet"


def test_options_of_the_jobs(spark):
    args = cli.parser().parse_args(["archive", "/a", "/c", "x", "y", "--servers", "h:1"])
    assert (args.starting, args.topics, args.servers) == ("earliest", ["x", "y"], "h:1")
    args = cli.parser().parse_args(["live", "pace", "/c", "--from-topic", "--salts", "3", "--per-batch", "10", "--state-partitions", "5"])
    assert (args.from_topic, args.salts, args.per_batch, args.state_partitions, args.starting) == (True, 3, 10, 5, "latest")


def test_repeated_batches_of_targets(spark):
    target = sinks.JdbcTarget(Database("jdbc:x:y"), "pace", ["a"])
    assert target.clear_statement(7) == "DELETE FROM pace WHERE batch = 7"
    rows = sinks.KafkaTarget.with_header(spark.range(1), 7).first()
    assert [(h.key, bytes(h["value"])) for h in rows.headers] == [("batch", b"7")]
    order = []
    topic = sinks.KafkaTarget("h:1", "t", ["key", "value"])
    object.__setattr__(topic, "columns", None)
    with pytest.raises(TypeError):
        sinks.fan_out(topic, lambda b, n: order.append(n))(spark.range(1), 7)
    assert order == [7]


def history(spark):
    return spark.createDataFrame([(1, 12.0), (2, 9.5)], "runner_id bigint, average_speed double")


def test_state_partitions_are_given_not_found(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert jobs.stream_session(spark).conf.get("spark.sql.shuffle.partitions") == before
    assert jobs.stream_session(spark, 37).conf.get("spark.sql.shuffle.partitions") == "37"
    few = spark.newSession()
    few.conf.set("spark.sql.shuffle.partitions", "500")
    assert jobs.stream_session(few).conf.get("spark.sql.shuffle.partitions") == "500"


@pytest.mark.parametrize("name", ["speed", "pace", "avg_speed", "comparison", "altitude_gain", "finish"])
def test_measures_publish_messages(spark, name):
    path = shared_path(spark, name)
    session = jobs.stream_session(spark)
    measure = measures(history(session))[name]
    stream = measure.published(fixtures.stream_telemetry(session, SF))
    target = sinks.fan_out(*measure.targets(files=f"{path}/files"))
    jobs.drain(sinks.to_target(stream, target, f"{path}/checkpoint"))
    written = spark.read.schema("value string, batch int").options(**sinks.CSV).csv(f"{path}/files/{measure.topic}")
    found = Counter(r.value for r in written.collect())
    telemetry = fixtures.telemetry(spark, SF)
    same = measure.published(telemetry)
    if measure.windowed or name == "comparison":
        # A window is out once the latest time less one second has passed its end.
        end = F.col("time") if measure.windowed else F.col("time") + F.expr("interval 1 second")
        latest = telemetry.agg(F.max("time")).first()[0]
        same = same.filter(end <= F.lit(latest) - F.expr("interval 1 second"))
    expected = Counter(r.value_text for r in same.collect())
    assert found == expected and found


def test_salted_estimates_are_the_same(spark):
    telemetry, past = fixtures.telemetry(spark, SF), history(spark)
    plain = live.finish_estimates(telemetry, past, 21).collect()
    salted = live.finish_estimates(telemetry, past, 21, salts=8).collect()
    assert Counter(map(tuple, salted)) == Counter(map(tuple, plain))
    assert len(plain) == telemetry.count()


def test_targets_of_a_measure():
    every = measures()
    assert "finish" not in every
    with pytest.raises(ValueError):
        every["speed"].targets()


def test_targets_by_address(spark):
    every = measures()
    database = Database("jdbc:x:y")
    kinds = [type(t).__name__ for t in every["pace"].targets("h:1", database, "/f")]
    assert kinds == ["KafkaTarget", "JdbcTarget", "FileTarget"]
    assert [t.table for t in every["elevation"].targets(database=database)] == ["altitude_gain"]
