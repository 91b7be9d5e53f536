"""State tables, totals per row, replays, dense ids, named and bucketed tables, bitmaps, bad rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from paceline import fixtures
from paceline.operators.clean import with_dense_id
from paceline.operators.distinct import distinct_bitmaps, distinct_counts, merged
from paceline.plans import history, improvement, live
from paceline.schemas import LIVE_TABLES, RAW_HEADERS, TELEMETRY
from paceline.session import shared_path
from paceline.sources import files, named
from paceline.streaming import jobs, sinks
from paceline.streaming.state import StateTable, TotalsTarget, open_windows

SF = "/root/testdata/sf0.001"
CLIMBS = LIVE_TABLES["altitude_gain"]
START = datetime.datetime(2024, 1, 1)


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


def totals_table(path, every):
    return StateTable(path, LIVE_TABLES["elev_gain_total"], ("runner_id",), every)


def test_state_is_one_snapshot_and_few_changes(spark):
    table = totals_table(shared_path(spark, "state"), 10)
    expected = {}
    for number in range(50):
        rows = [(number % 7, at(number), float(number))]
        expected[number % 7] = float(number)
        table(spark.createDataFrame(rows, CLIMBS).coalesce(1), number)
    assert {r.runner_id: r.value for r in table.read(spark).collect()} == expected
    files_read = table.input_files(spark)
    snapshot = [f for f in files_read if "/snapshots/" in f]
    changes = [f for f in files_read if "/changes/" in f]
    assert len({f.split("/snapshots/")[1].split("/")[0] for f in snapshot}) == 1
    assert 1 <= len(changes) <= 10
    path = table.path
    assert len(table._epochs(spark)) <= 3 and len(table._snapshots(spark)) <= 2, path


def test_state_of_a_batch_that_runs_again(spark):
    table = totals_table(shared_path(spark, "again"), 2)
    frame = lambda *rows: spark.createDataFrame([(r, at(0), v) for r, v in rows], CLIMBS)
    for number, rows in enumerate([[(1, 1.0), (2, 1.0)], [(1, 2.0)], [(2, 3.0)], [(1, 4.0)]]):
        table(frame(*rows), number)
        table(frame(*rows), number)
    assert sorted((r.runner_id, r.value) for r in table.read(spark).collect()) == [(1, 4.0), (2, 3.0)]
    assert sorted((r.runner_id, r.value) for r in table.read(spark, 3).collect()) == [(1, 2.0), (2, 3.0)]
    assert sorted((r.runner_id, r.value) for r in table.read(spark, 2).collect()) == [(1, 2.0), (2, 1.0)]


def test_a_fold_that_failed_is_done_again(spark):
    table = totals_table(shared_path(spark, "fold"), 1)
    frame = lambda v: spark.createDataFrame([(1, at(0), v)], CLIMBS)
    table(frame(1.0), 0)
    # What a fold leaves that was cut off: files without the mark of completeness.
    frame(9.0).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table.path}/snapshots/1")
    assert [r.value for r in table.read(spark).collect()] == [1.0]
    table(frame(2.0), 1)
    assert table._snapshots(spark) == [1] and [r.value for r in table.read(spark).collect()] == [2.0]


def test_state_of_nothing(spark):
    assert totals_table(shared_path(spark, "none"), 3).read(spark).count() == 0


def test_totals_per_row_over_batches_and_again(spark):
    target = TotalsTarget(shared_path(spark, "totals"), every=2)
    random.seed(4)
    expected, sums = [], {}
    for number in range(5):
        rows = [(r, at(10 * number + i), round(random.random() * 5, 4)) for r in (1, 2, None) for i in range(3) if random.random() < 0.8]
        for r, t, v in sorted(rows, key=lambda x: (str(x[0]), x[1])):
            sums[r] = round(sums.get(r, 0.0) + v, 4)
            expected.append((r, t, sums[r]))
        for _ in range(2 if number in (1, 2, 4) else 1):
            target(spark.createDataFrame(rows, CLIMBS), number)
    found = [(r.runner_id, r.time, r.value) for r in spark.read.parquet(f"{target.path}/rows").collect()]
    key = lambda x: (str(x[0]), x[1])
    assert sorted(found, key=key) == sorted(expected, key=key)


def test_a_replay_counts_twice_without_and_once_with_the_guard(spark):
    path = shared_path(spark, "replay")
    target = sinks.FileTarget(f"{path}/climbs")
    rows = spark.createDataFrame([(1, at(5), 10.0)], CLIMBS)
    for _ in range(2):
        target(rows, 0)
        for name, guard in (("plain", lambda t: t), ("once", live.once)):
            stream = jobs.stream_session(spark, 2).readStream.schema(CLIMBS).parquet(f"{path}/climbs")
            totals = totals_table(f"{path}/{name}", 10)
            jobs.drain(sinks.to_target(live.climb_totals(guard(stream)), totals, f"{path}/c-{name}", "update"))
    value = lambda name: [r.value for r in totals_table(f"{path}/{name}", 10).read(spark).collect()]
    assert (value("plain"), value("once")) == ([20.0], [10.0])


def test_open_windows(spark):
    path = shared_path(spark, "open")
    telemetry = [(r, at(s), 1.0, 1.0, 1.0, 1.0, 1, 2.0) for r, s in ((1, 0), (2, 1), (1, 12), (2, 13))]
    spark.createDataFrame(telemetry, TELEMETRY).write.parquet(f"{path}/in")
    stream = jobs.stream_session(spark, 2).readStream.schema(TELEMETRY).parquet(f"{path}/in")
    jobs.drain(sinks.to_files(live.as_table(live.average_speeds(live.speeds(stream)), "avg_speed"), f"{path}/t", f"{path}/c"))
    assert sorted((r.runner_id, r.time) for r in open_windows(spark, f"{path}/c").collect()) == [(1, at(15)), (2, at(15))]


def test_dense_ids_and_even_ranges(spark):
    path = shared_path(spark, "dense")
    spark.range(1000).filter("id % 97 > 3 or id < 400").selectExpr("id as v").repartition(13).write.parquet(path)
    for frame in (spark.read.parquet(path), spark.read.parquet(path).filter("v % 5 = 0"), spark.read.parquet(path).filter("v < 0")):
        found = with_dense_id(frame)
        rows = found.count()
        assert sorted(r.id for r in found.collect()) == list(range(rows))
        assert {r.v for r in found.collect()} == {r.v for r in frame.collect()}
        ranges = [found.filter((F.col("id") >= rows * i // 4) & (F.col("id") < rows * (i + 1) // 4)).count() for i in range(4)]
        assert max(ranges) - min(ranges) <= 1


def test_named_tables(spark):
    path = shared_path(spark, "named")
    name = f"totals_{path[-32:]}"
    named.register(spark, name, path, CLIMBS)
    assert named.latest_named(spark, name).count() == 0
    for value in (1.0, 2.0):
        spark.createDataFrame([(1, at(value), value)], CLIMBS).write.mode("append").parquet(path)
        assert named.latest_named(spark, name).first().value == value
    assert named.read_named(spark, name).count() == 2
    for strange in ("no_such_table", "no_such_table; drop table x"):
        with pytest.raises(Exception, match="no_such_table"):
            named.read_named(spark, strange)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_need_no_shuffle_of_the_results(spark):
    path = shared_path(spark, "buckets")
    results = named.write_bucketed(fixtures.distance_results(spark, SF), f"r_{path[-32:]}", path, "athlete_id", 4)
    assert "Exchange" not in plan(history.weighted_history(results, 21, 2001))
    assert "Exchange" not in plan(improvement._careers(results))
    assert "Exchange" in plan(improvement._careers(fixtures.distance_results(spark, SF)))


def test_bitmaps_of_any_ids(spark):
    random.seed(6)
    ids = [0, 1, -1, 32768, 32767, -32768, 2**62, -(2**62), None] + [random.randint(-10**5, 10**5) for _ in range(400)]
    rows = [(random.choice(["a", "b", None]), i) for i in ids * 2] + [("only null", None)]
    frame = spark.createDataFrame(rows, "label string, id long")
    parts = [distinct_bitmaps(frame.filter(F.pmod(F.hash("id"), F.lit(3)) == i), "label", "id") for i in range(3)]
    found = {r.label: r.n for r in distinct_counts(merged("label", *parts), "label", "n").collect()}
    assert found == {label: len({i for x, i in rows if x == label and i is not None}) for label in ("a", "b", None, "only null")}


def test_rows_that_do_not_fit(spark):
    path = shared_path(spark, "bad")
    whole = [",".join(["x"] * len(RAW_HEADERS)), ",".join(["y"] * len(RAW_HEADERS))]
    lines = [",".join(RAW_HEADERS), whole[0], "a,b", whole[1] + ",more", '"q,1"' + ",z" * (len(RAW_HEADERS) - 1)]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    good, bad = files.sort_out_results(spark, path, f"{path}-out")
    assert sorted(r[0] for r in good.collect()) == ["q,1", "x"] and good.columns == RAW_HEADERS
    assert sorted(r[0] for r in bad.collect()) == ["a,b", whole[1] + ",more"]
    assert bad.count() == 2
