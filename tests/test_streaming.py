"""Late rows, restarts, several batches, and sinks."""

import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paceline.plans import live
from paceline.schemas import LIVE_TABLES, TELEMETRY
from paceline.session import shared_path, shared_root
from paceline.sources import files, jdbc, kafka
from paceline.streaming import jobs, sinks

START = datetime.datetime(2024, 1, 1)


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


def put(spark, folder, number, rows):
    """One file of (runner, second, altitude, speed); files are taken in order of their time stamp."""
    full = [(r, at(t), 0.0, 0.0, float(a), t * 2.5, 100, float(s)) for r, t, a, s in rows]
    path = f"{folder}/part={number:03d}"
    spark.createDataFrame(full, TELEMETRY).coalesce(1).write.parquet(path)


def stream(spark, folder, per_batch=1):
    session = jobs.stream_session(spark)
    reader = session.readStream.schema(TELEMETRY).option("maxFilesPerTrigger", per_batch)
    return reader.option("recursiveFileLookup", "true").parquet(folder)


def seconds(rows, column="time"):
    return Counter((r.runner_id, int((r[column] - START).total_seconds())) for r in rows)


def test_late_rows_are_dropped(spark):
    folder = shared_path(spark, "late")
    put(spark, folder, 1, [(1, t, 0, 2) for t in range(0, 61)])
    # Spark holds rows against the watermark of the batch before, so one batch must lie between.
    put(spark, folder, 2, [(1, 61, 0, 2)])
    put(spark, folder, 3, [(1, 40, 100, 50), (1, 62, 0, 2)])
    put(spark, folder, 4, [(1, t, 0, 2) for t in range(63, 80)])
    windows = live.average_speeds(live.speeds(stream(spark, folder)))
    table = jobs.drain_to_table(spark, live.as_table(windows, "avg_speed"), "late").collect()
    assert {r.avg_speed for r in table} == {2.0}
    # A window is out once the latest time less one second has passed its end: 79 - 1 >= 75.
    assert max(seconds(table)) == (1, 75)


def test_rows_within_the_delay_are_kept_in_batches(spark):
    """Many batches give the same as one, if no row is late."""
    folder = shared_path(spark, "batches")
    rows = [(r, t, (t * 7 + r) % 11, 2 + t % 3) for t in range(60) for r in range(3)]
    for number in range(6):
        put(spark, folder, number, [x for x in rows if x[1] // 10 == number])
    telemetry = spark.read.schema(TELEMETRY).option("recursiveFileLookup", "true").parquet(folder)
    speed = live.speeds(telemetry)
    for streamed, batch, last in [
        (live.comparisons(live.speeds(stream(spark, folder))), live.comparisons(speed), 54),
        (live.altitude_gains_live(stream(spark, folder)), live.altitude_gains(telemetry), 59),
        (
            live.as_table(live.elevation_windows_live(stream(spark, folder)), "value"),
            live.as_table(live.elevation_windows(telemetry), "value"),
            50,
        ),
    ]:
        found = jobs.drain_to_table(spark, streamed, "batches").collect()
        expected = batch.filter(F.col("time") <= F.lit(at(last))).collect()
        assert Counter(map(tuple, found)) == Counter(map(tuple, expected))


def test_restart_repeats_nothing(spark):
    folder, root = shared_path(spark, "restart"), shared_path(spark, "restart_out")

    def run():
        windows = live.average_speeds(live.speeds(stream(spark, folder)))
        rows = live.as_table(windows, "avg_speed")
        jobs.drain(sinks.to_files(rows, f"{root}/table", f"{root}/checkpoint"))
        return spark.read.parquet(f"{root}/table").collect()

    put(spark, folder, 1, [(1, t, 0, 2) for t in range(0, 12)])
    first = run()
    assert seconds(first) == {(1, 5): 1, (1, 10): 1}
    put(spark, folder, 2, [(1, t, 0, 4) for t in range(12, 31)])
    second = run()
    assert seconds(second) == {(1, end): 1 for end in (5, 10, 15, 20, 25)} or seconds(second) == {
        (1, end): 1 for end in (5, 10, 15, 20, 25, 30)
    }
    # The open window kept its first two rows over the restart: (2 + 2 + 4 + 4 + 4) / 5.
    assert {r.avg_speed for r in second if r.time == at(15)} == {3.2}
    assert seconds(run()) == seconds(second)


def test_running_total_grows_with_the_table(spark):
    folder, path = shared_path(spark, "totals_in"), shared_path(spark, "totals")
    schema = LIVE_TABLES["altitude_gain"]
    for number, value in enumerate([5.0, 2.5, 0.0]):
        rows = spark.createDataFrame([(1, at(number * 5), value)], schema)
        rows.coalesce(1).write.mode("append").parquet(folder)
    table = jobs.stream_session(spark).readStream.schema(schema).option("maxFilesPerTrigger", 1)
    totals = []

    def keep(batch, number):
        totals.extend(r.value for r in batch.collect())

    jobs.drain(sinks.to_target(live.climb_totals(table.parquet(folder)), keep, f"{path}/c", "update"))
    assert totals == [5.0, 7.5, 7.5]
    batch = live.total_climb(spark.read.parquet(folder)).orderBy("time").collect()
    assert [r.value for r in batch] == [5.0, 7.5, 7.5]


def test_a_batch_that_is_run_again_is_there_once(spark):
    path = shared_path(spark, "again")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    target = sinks.fan_out(sinks.FileTarget(f"{path}/all"), sinks.FileTarget(f"{path}/ids", ["id"]))
    target(rows, 0)
    target(rows.filter("id = 1"), 1)
    target(rows, 0)
    assert spark.read.parquet(f"{path}/all").count() == 3
    assert spark.read.parquet(f"{path}/ids").columns == ["id", "batch"]


def test_fan_out_reads_its_input_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    rows = spark.range(10).coalesce(1).mapInPandas(seen, "id bigint")
    path = shared_path(spark, "once")
    sinks.fan_out(sinks.FileTarget(f"{path}/a"), sinks.FileTarget(f"{path}/b"))(rows, 0)
    assert reads.value == 10


def test_archive_routes_topics(spark):
    path = shared_path(spark, "log")
    rows = [("speed", "1", "t,2.5"), ("pace", "1", "t,6.7"), ("heart_rate", "1", "t,99")]
    files.write_topics(spark.createDataFrame(rows, "topic string, key string, value string"), path)
    messages = files.stream_topics(jobs.stream_session(spark), path, ["speed", "heart_rate"])
    before = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    jobs.drain(jobs.archive(messages, f"{path}-out/table", f"{path}-out/checkpoint"))
    table = spark.read.parquet(f"{path}-out/table")
    assert {(r.topic, r.value) for r in table.collect()} == {("speed", "t,2.5"), ("heart_rate", "t,99")}
    ahead = table.first().time - before
    assert datetime.timedelta(minutes=59) < ahead < datetime.timedelta(minutes=70)


def test_telemetry_files(spark):
    path = shared_path(spark, "semicolons")
    lines = ["Time;Lat;Lon;Alt;Dist;HR;Speed", ";1;2;3;4;5;6", "2024-01-01 00:00:01;1;2;3;4;5;6"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    batch = files.read_telemetry_files(spark, path)
    assert [r.value for r in batch.collect()] == [",1,2,3,4,5,6", "2024-01-01 00:00:01,1,2,3,4,5,6"]
    streamed = files.stream_telemetry_files(jobs.stream_session(spark), path, F.lit(9))
    assert {r.key for r in jobs.drain_to_table(spark, streamed, "files").collect()} == {"9"}


def test_empty_table(spark):
    path = shared_path(spark, "reset")
    schema = LIVE_TABLES["pace"]
    files.write_table(spark.createDataFrame([(1, START, 5.0)], schema), path)
    files.empty_table(spark, path, schema)
    table = files.read_table(spark, path)
    assert table.count() == 0 and table.schema.names == schema.names


def test_results_file_with_a_wrong_header(spark):
    path = shared_path(spark, "wrong")
    spark.createDataFrame([("1", "2")], "a string, b string").write.csv(path, header=True)
    with pytest.raises(Exception, match="(?i)header|schema"):
        files.read_results(spark, path).collect()


def test_kafka_options():
    assert kafka.read_options("h:1", ["a", "b"], "earliest") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b",
        "startingOffsets": "earliest", "failOnDataLoss": "false",
    }


def test_jdbc_options():
    database = jdbc.Database("jdbc:x:y", {"user": "u", "driver": "d"})
    assert database.options("t", numPartitions=4) == {
        "url": "jdbc:x:y", "dbtable": "t", "user": "u", "driver": "d", "numPartitions": "4",
    }


class Unconfigured:
    """A session without ``spark.checkpoint.dir``."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "a"})


def test_only_a_local_session_may_name_no_shared_folder():
    assert shared_root(Unconfigured("local[2]")) == shared_root(Unconfigured("local[2]"))
    with pytest.raises(ValueError):
        shared_root(Unconfigured("spark://host:7077"))


def test_shared_root_is_the_configured_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_path(spark, "x") != shared_path(spark, "x")
