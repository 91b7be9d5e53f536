"""The registered queries: each takes a session and a folder of test tables."""

from __future__ import annotations

import contextlib

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline import fixtures
from paceline.functions.bands import AGE_BANDS, DISTANCE_BANDS, band
from paceline.functions.parsing import (
    clock_seconds,
    kilometres,
    limit_hours,
    speed_always_metres,
    speed_mixed_units,
    whole_number,
)
from paceline.functions.telemetry import encode, from_messages, to_messages, to_topic
from paceline.operators.clean import (
    conform,
    distance_limited,
    is_time_limited,
    length,
    normalise_names,
    time_limited,
    with_content_id,
    with_dense_id,
)
from paceline.operators.distinct import distinct_bitmaps, distinct_counts, merged
from paceline.plans import history, improvement, live, questions
from paceline.schemas import LIVE_TABLES, RAW_HEADERS, TELEMETRY, TELEMETRY_FIELDS
from paceline.session import shared_path
from paceline.sources import files, named
from paceline.streaming import jobs, measures
from paceline.streaming.sinks import CSV, FileTarget, fan_out, to_files, to_target
from paceline.streaming.state import StateTable, TotalsTarget, late_counts, open_windows

Spark = SparkSession


# --- cleaning ---------------------------------------------------------------------------------


def clean_time_limited(spark: Spark, sf: str) -> DataFrame:
    return time_limited(fixtures.race_results_raw(spark, sf))


def clean_distance_limited(spark: Spark, sf: str) -> DataFrame:
    return distance_limited(fixtures.race_results_raw(spark, sf))


def _counted(df: DataFrame, *columns) -> DataFrame:
    """How often each text occurs, with what is made of it."""
    named = df.select(*columns)
    return named.groupBy(*named.columns).agg(F.count("*").alias("num_rows"))


def split_by_type(spark: Spark, sf: str) -> DataFrame:
    kind = (
        F.when(is_time_limited(length()), "time")
        .when(~is_time_limited(length()), "distance")
        .otherwise("neither")
    )
    return _counted(fixtures.race_results_raw(spark, sf), kind.alias("kind"))


def normalised_names(spark: Spark, sf: str) -> DataFrame:
    as_in_file = fixtures.race_results_raw(spark, sf).toDF(*RAW_HEADERS)
    return normalise_names(as_in_file).drop("athlete_age_category")


def age_band(spark: Spark, sf: str) -> DataFrame:
    age = F.try_subtract(
        whole_number(F.col("year_of_event")), whole_number(F.col("athlete_year_of_birth"))
    )
    ages = fixtures.race_results_raw(spark, sf).select(age.alias("athlete_age"))
    return _counted(ages, "athlete_age", band(F.col("athlete_age"), AGE_BANDS).alias("age_group"))


def distance_band(spark: Spark, sf: str) -> DataFrame:
    lengths = fixtures.race_results_raw(spark, sf).select(kilometres(length()).alias("distance_km"))
    label = band(F.col("distance_km"), DISTANCE_BANDS)
    return _counted(lengths, "distance_km", label.alias("distance_group_km"))


def distance_km(spark: Spark, sf: str) -> DataFrame:
    return _counted(
        fixtures.race_results_raw(spark, sf), length().alias("length"), kilometres(length()).alias("km")
    )


def duration_seconds(spark: Spark, sf: str) -> DataFrame:
    text = F.col("athlete_performance")
    return _counted(
        fixtures.race_results_raw(spark, sf), text, clock_seconds(text).alias("seconds")
    )


def time_limit_hours(spark: Spark, sf: str) -> DataFrame:
    limits = fixtures.race_results_raw(spark, sf).filter(is_time_limited(length()))
    return _counted(limits, length().alias("length"), limit_hours(length()).alias("hours"))


def speed_kmph(spark: Spark, sf: str) -> DataFrame:
    text = F.col("athlete_average_speed")
    return _counted(
        fixtures.race_results_raw(spark, sf),
        text,
        speed_always_metres(text).alias("time_limited_kmph"),
        speed_mixed_units(text).alias("distance_limited_kmph"),
    )


def content_id(spark: Spark, sf: str) -> DataFrame:
    raw = fixtures.race_results_raw(spark, sf).drop("athlete_age_category")
    return with_content_id(raw).select("content_id")


def row_id(spark: Spark, sf: str) -> DataFrame:
    """Number of rows and of distinct ids, which are equal."""
    ids = fixtures.distance_results(spark, sf).groupBy("id").agg(F.count("*").alias("n"))
    return ids.agg(F.sum("n").alias("num_rows"), F.count("*").alias("num_ids"))


def dense_row_id(spark: Spark, sf: str) -> DataFrame:
    """Ids over many partitions: how many, how many distinct, the first and the last."""
    path = shared_path(spark, "dense")
    fixtures.distance_results(spark, sf).drop("id").repartition(16).write.parquet(path)
    ids = with_dense_id(spark.read.parquet(path)).groupBy("id").agg(F.count("*").alias("n"))
    return ids.agg(
        F.sum("n").alias("num_rows"), F.count("*").alias("num_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def source_bad_rows(spark: Spark, sf: str) -> DataFrame:
    """A results file in which some rows have too few fields and some too many: good rows, and the text of others."""
    path = shared_path(spark, "bad_rows")
    raw = fixtures.race_results_raw(spark, sf)
    line = lambda *more: F.concat_ws(",", *more)
    fields = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in raw.columns]
    text = F.when(F.col("athlete_gender") == "X", line(*fields[:5])).when(F.col("athlete_club").isNull(), line(*fields, F.lit("more")))
    # With a separator that no row has, so that lines are written as they are.
    raw.select(text.otherwise(line(*fields)).alias(",".join(RAW_HEADERS))).write.csv(path, header=True, sep="\x01")
    good, bad = files.sort_out_results(spark, path, f"{path}-sorted")
    together = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in good.columns])
    return good.select(F.lit("good").alias("kind"), together.alias("line")).union(bad.select(F.lit("bad"), files.BAD))


def source_results_csv(spark: Spark, sf: str) -> DataFrame:
    """The raw results through a CSV file, then cleaned."""
    path = shared_path(spark, "results_csv")
    fixtures.race_results_raw(spark, sf).toDF(*RAW_HEADERS).write.csv(path, header=True)
    return distance_limited(normalise_names(files.read_results(spark, path)))


# --- questions --------------------------------------------------------------------------------


def _of_distance(question):
    return lambda spark, sf: question(fixtures.distance_results(spark, sf))


def _of_both(question):
    return lambda spark, sf: question(
        fixtures.time_results(spark, sf), fixtures.distance_results(spark, sf)
    )


def distance_per_decade(spark: Spark, sf: str) -> DataFrame:
    decades = questions.distance_per_decade(fixtures.time_results(spark, sf))
    return decades.withColumn("decade_start", F.col("decade_start").cast("string"))


def _history(spark: Spark, sf: str) -> DataFrame:
    return history.weighted_history(
        fixtures.distance_results(spark, sf), fixtures.RACE_KM, fixtures.REFERENCE_YEAR
    )


def _bucketed(spark: Spark, sf: str, columns: list[str]) -> DataFrame:
    """The distance-limited results in buckets of the athlete."""
    path = shared_path(spark, "bucketed")
    results = fixtures.distance_results(spark, sf).select(*columns)
    return named.write_bucketed(results, f"results_{path[-32:]}", path, "athlete_id", 8)


def weighted_history_bucketed(spark: Spark, sf: str) -> DataFrame:
    """The runners' histories without a shuffle of the results."""
    results = _bucketed(spark, sf, ["athlete_id", "distance_km", "year_of_event", "athlete_average_speed_kmph"])
    return history.weighted_history(results, fixtures.RACE_KM, fixtures.REFERENCE_YEAR)


def q9_bucketed(spark: Spark, sf: str) -> DataFrame:
    columns = ["athlete_id", "distance_group_km", "distance_km", "event_dates", "athlete_average_speed_kmph"]
    return improvement.most_improved(_bucketed(spark, sf, columns))


def q6_incremental(spark: Spark, sf: str) -> DataFrame:
    """Athletes per country: bitmaps of the time-limited results are stored, those of the others added to them."""
    path = shared_path(spark, "bitmaps")
    files.write_table(distinct_bitmaps(fixtures.time_results(spark, sf), "athlete_country", "athlete_id"), path)
    more = distinct_bitmaps(fixtures.distance_results(spark, sf), "athlete_country", "athlete_id")
    counts = distinct_counts(merged("athlete_country", files.read_table(spark, path), more), "athlete_country", "num_of_athletes")
    return counts.withColumnRenamed("athlete_country", "country")


# --- live measures in batch -------------------------------------------------------------------


def _window_rows(windows: DataFrame, value: str) -> DataFrame:
    """Windows with both their times: that of the topic and that of the table."""
    return windows.select(
        "runner_id", live.topic_time().alias("topic_time"), live.table_time().alias("time"), value
    )


def encode_telemetry(spark: Spark, sf: str) -> DataFrame:
    return to_messages(fixtures.telemetry(spark, sf))


def decode_telemetry(spark: Spark, sf: str) -> DataFrame:
    return from_messages(to_messages(fixtures.telemetry(spark, sf)))


def speed(spark: Spark, sf: str) -> DataFrame:
    measured = live.speeds(fixtures.telemetry(spark, sf))
    return to_topic(measured, "speed", F.col("speed")).drop("topic")


def pace(spark: Spark, sf: str) -> DataFrame:
    return live.paces(live.speeds(fixtures.telemetry(spark, sf)))


def avg_speed_5s(spark: Spark, sf: str) -> DataFrame:
    return _window_rows(
        live.average_speeds(live.speeds(fixtures.telemetry(spark, sf))), "avg_speed"
    )


def speed_compare(spark: Spark, sf: str) -> DataFrame:
    return live.comparisons(live.speeds(fixtures.telemetry(spark, sf)))


def altitude_gain(spark: Spark, sf: str) -> DataFrame:
    return live.altitude_gains(fixtures.telemetry(spark, sf))


def elevation_5s(spark: Spark, sf: str) -> DataFrame:
    return live.as_table(live.elevation_windows(fixtures.telemetry(spark, sf)), "value")


def total_climb(spark: Spark, sf: str) -> DataFrame:
    return live.total_climb(elevation_5s(spark, sf))


def latest_total(spark: Spark, sf: str) -> DataFrame:
    """Of the totals, without the course they took."""
    return live.latest(live.climb_totals(elevation_5s(spark, sf)))


def table_by_name(spark: Spark, sf: str) -> DataFrame:
    """The latest total, of a table that is found by its name."""
    path = shared_path(spark, "named")
    files.write_table(live.climb_totals(elevation_5s(spark, sf)), path)
    name = f"elev_gain_total_{path[-32:]}"
    named.register(spark, name, path, LIVE_TABLES["elev_gain_total"])
    return named.latest_named(spark, name)


def latest_per_runner(spark: Spark, sf: str) -> DataFrame:
    return live.latest_per_runner(live.climb_totals(elevation_5s(spark, sf)))


def finish_estimate(spark: Spark, sf: str) -> DataFrame:
    return live.finish_estimates(
        fixtures.telemetry(spark, sf), _history(spark, sf), fixtures.RACE_KM
    )


# --- live measures as streams -----------------------------------------------------------------

# Few runners and one batch: each partition of state is a task in every batch.
STATE_PARTITIONS = 8


def _stream(spark: Spark, sf: str) -> DataFrame:
    return fixtures.stream_telemetry(jobs.stream_session(spark, STATE_PARTITIONS), sf)


def stream_speed(spark: Spark, sf: str) -> DataFrame:
    """From messages to messages, as between two topics."""
    measured = live.speeds(from_messages(to_messages(_stream(spark, sf))))
    return jobs.drain_to_table(
        spark, to_topic(measured, "speed", F.col("speed")).drop("topic"), "speed"
    )


def stream_pace(spark: Spark, sf: str) -> DataFrame:
    return jobs.drain_to_table(spark, live.paces(live.speeds(_stream(spark, sf))), "pace")


def stream_avg_speed_5s(spark: Spark, sf: str) -> DataFrame:
    windows = live.average_speeds(live.speeds(_stream(spark, sf)))
    return jobs.drain_to_table(spark, _window_rows(windows, "avg_speed"), "avg_speed")


def stream_compare(spark: Spark, sf: str) -> DataFrame:
    return jobs.drain_to_table(
        spark, live.comparisons(live.speeds(_stream(spark, sf))), "comparison"
    )


def stream_altitude_gain(spark: Spark, sf: str) -> DataFrame:
    return jobs.drain_to_table(spark, live.altitude_gains_live(_stream(spark, sf)), "gains")


def stream_elevation_5s(spark: Spark, sf: str) -> DataFrame:
    windows = live.elevation_windows_live(_stream(spark, sf))
    return jobs.drain_to_table(spark, live.as_table(windows, "value"), "altitude_gain")


def stream_total_climb(spark: Spark, sf: str) -> DataFrame:
    """Two chained streams: windows to a table, totals from the table."""
    session = jobs.stream_session(spark, STATE_PARTITIONS)
    windows = live.elevation_windows_live(fixtures.stream_telemetry(session, sf))
    path = shared_path(spark, "altitude_gain")
    jobs.drain(to_files(live.as_table(windows, "value"), f"{path}/table", f"{path}/checkpoint"))
    table = session.readStream.schema(LIVE_TABLES["altitude_gain"]).parquet(f"{path}/table")
    return jobs.drain_last_state(spark, live.climb_totals(table), "totals", ["runner_id"])


def stream_finish_estimate(spark: Spark, sf: str) -> DataFrame:
    """The history is stored first: the stream reads it again in every micro-batch."""
    session = jobs.stream_session(spark, STATE_PARTITIONS)
    path = shared_path(spark, "history")
    files.write_table(_history(spark, sf), path)
    estimates = live.finish_estimates(
        fixtures.stream_telemetry(session, sf),
        files.read_table(session, path),
        fixtures.RACE_KM,
        salts=8,
    )
    return jobs.drain_to_table(spark, estimates, "finish_estimation")


# --- streams over several batches -------------------------------------------------------------


def _span(spark: Spark, sf: str) -> tuple[int, int]:
    """First and last second of the telemetry."""
    at = F.unix_timestamp("time")
    return tuple(fixtures.telemetry(spark, sf).agg(F.min(at), F.max(at)).first())


def _quarters(spark: Spark, sf: str) -> list:
    """The telemetry in four parts, in order of time."""
    first, last = _span(spark, sf)
    cuts = [first + (last + 1 - first) * i // 4 for i in range(5)]
    at = F.unix_timestamp("time")
    return [(at >= a) & (at < b) for a, b in zip(cuts, cuts[1:])]


def _in_batches(spark: Spark, sf: str, name: str, plan, parts: list) -> DataFrame:
    """A stream stopped after each part has arrived and started again for the next one, from its
    checkpoint: state and watermark are carried over."""
    root = shared_path(spark, name)
    for part in parts:
        arrived = fixtures.telemetry(spark, sf).select(*TELEMETRY.names).filter(part)
        arrived.write.mode("append").parquet(f"{root}/arrived")
        session = jobs.stream_session(spark, STATE_PARTITIONS)
        stream = plan(session.readStream.schema(TELEMETRY).parquet(f"{root}/arrived"))
        jobs.drain(to_files(stream, f"{root}/table", f"{root}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{root}/table")


def _average_rows(telemetry: DataFrame) -> DataFrame:
    return _window_rows(live.average_speeds(live.speeds(telemetry)), "avg_speed")


def stream_batches_avg_speed(spark: Spark, sf: str) -> DataFrame:
    return _in_batches(spark, sf, "avg_speed_batches", _average_rows, _quarters(spark, sf))


def stream_batches_compare(spark: Spark, sf: str) -> DataFrame:
    plan = lambda t: live.comparisons(live.speeds(t))
    return _in_batches(spark, sf, "comparison_batches", plan, _quarters(spark, sf))


def stream_batches_elevation(spark: Spark, sf: str) -> DataFrame:
    plan = lambda t: live.as_table(live.elevation_windows_live(t), "value")
    return _in_batches(spark, sf, "elevation_batches", plan, _quarters(spark, sf))


def stream_late_rows(spark: Spark, sf: str) -> DataFrame:
    """The second half of the race arrives first, so the first half is late and dropped."""
    first, last = _span(spark, sf)
    middle = (first + last) // 2 // 5 * 5
    at = F.unix_timestamp("time")
    return _in_batches(spark, sf, "late", _average_rows, [at >= middle, at < middle])


def stream_late_counts(spark: Spark, sf: str) -> DataFrame:
    """The second half of the race arrives first: rows read, kept and dropped, in order of arrival."""
    first, last = _span(spark, sf)
    middle = (first + last) // 2 // 5 * 5
    at, root, read = F.unix_timestamp("time"), shared_path(spark, "late_counts"), {}
    for part in (at >= middle, at < middle):
        arrived = fixtures.telemetry(spark, sf).select(*TELEMETRY.names).filter(part)
        arrived.write.mode("append").parquet(f"{root}/arrived")
        session = jobs.stream_session(spark, STATE_PARTITIONS)
        counts = live.window_rows(live.speeds(session.readStream.schema(TELEMETRY).parquet(f"{root}/arrived")))
        target = FileTarget(f"{root}/table", ["rows"])
        progress = jobs.drain(to_target(counts, target, f"{root}/checkpoint")).recentProgress
        read |= {p.batchId: p.numInputRows for p in progress if p.numInputRows}
    counts = late_counts(spark, f"{root}/checkpoint", f"{root}/table", read)
    return counts.withColumn("batch", F.when(F.col("batch") == min(read), "first").otherwise("second"))


def stream_open_windows(spark: Spark, sf: str) -> DataFrame:
    """Windows of mean speed that a stream still held when it was stopped."""
    root = shared_path(spark, "open")
    jobs.drain(to_files(_average_rows(_stream(spark, sf)), f"{root}/table", f"{root}/checkpoint"))
    return open_windows(spark, f"{root}/checkpoint").select("runner_id", "time")


def stream_restart(spark: Spark, sf: str) -> DataFrame:
    """A fan-out to three tables whose last target fails once: the batch is run again, rows are there once."""
    root = shared_path(spark, "restart")
    failures = []

    def breaks_once(batch: DataFrame, number: int) -> None:
        if not failures:
            failures.append(number)
            raise RuntimeError("a target is down")

    tables = [FileTarget(f"{root}/{name}", ["runner_id", "time", "speed"]) for name in ("one", "two", "three")]
    for _ in range(2):
        target = fan_out(*tables[:2], breaks_once, tables[2])
        writer = to_target(live.speeds(_stream(spark, sf)), target, f"{root}/checkpoint")
        with contextlib.suppress(StreamingQueryException):
            jobs.drain(writer)
    read = [spark.read.parquet(f"{root}/{name}").select("runner_id", "time", "speed", F.lit(name).alias("target"))
            for name in ("one", "two", "three")]
    return read[0].union(read[1]).union(read[2])


def _climbed_windows(spark: Spark, sf: str, root: str, parts: list, again: tuple[int, ...] = ()):
    """Climbed windows as a stream writes them to a table, part by part; batches in ``again`` are written once
    more, as after a crash between the table and the commit. Yields after each."""
    target = FileTarget(f"{root}/climbs")
    for part in parts:
        arrived = fixtures.telemetry(spark, sf).select(*TELEMETRY.names).filter(part)
        arrived.write.mode("append").parquet(f"{root}/arrived")
        session = jobs.stream_session(spark, STATE_PARTITIONS)
        stream = live.elevation_windows_live(session.readStream.schema(TELEMETRY).parquet(f"{root}/arrived"))
        jobs.drain(to_target(live.as_table(stream, "value"), target, f"{root}/first"))
        yield session
    for number in again:
        written = spark.read.parquet(f"{root}/climbs").filter(F.col("batch") == number).drop("batch")
        files.write_table(written, f"{root}/kept-{number}")
        target(spark.read.parquet(f"{root}/kept-{number}"), number)
        yield jobs.stream_session(spark, STATE_PARTITIONS)


def _climbs(session: Spark, root: str) -> DataFrame:
    return live.once(session.readStream.schema(LIVE_TABLES["altitude_gain"]).parquet(f"{root}/climbs"))


def stream_total_replayed(spark: Spark, sf: str) -> DataFrame:
    """Totals of windows of which two batches are written again between runs: each window counts once."""
    root = shared_path(spark, "replayed")
    totals = StateTable(f"{root}/totals", LIVE_TABLES["elev_gain_total"], ("runner_id",), every=2)
    quarters = _quarters(spark, sf)
    halves = [quarters[0] | quarters[1], quarters[2] | quarters[3]]
    for session in _climbed_windows(spark, sf, root, halves, again=(0, 1)):
        jobs.drain(to_target(live.climb_totals(_climbs(session, root)), totals, f"{root}/second", "update"))
    return totals.read(spark)


def stream_total_per_insert(spark: Spark, sf: str) -> DataFrame:
    """A total after each window, over four batches of windows."""
    root = shared_path(spark, "per_insert")
    target = TotalsTarget(f"{root}/totals")
    for session in _climbed_windows(spark, sf, root, _quarters(spark, sf)):
        jobs.drain(to_target(_climbs(session, root), target, f"{root}/second"))
    return spark.read.parquet(f"{root}/totals/rows").select("runner_id", "time", "value")


def chained_topics(spark: Spark, sf: str) -> DataFrame:
    """Speed to a topic log, and pace from the messages found there."""
    root = shared_path(spark, "chain")
    speeds = measures.measures()["speed"].published(_stream(spark, sf))
    log = speeds.select(F.lit("speed").alias("topic"), "key", F.col("value_text").alias("value"))
    jobs.drain(to_files(log, f"{root}/log", f"{root}/first", partition_by="topic"))
    messages = files.stream_topics(jobs.stream_session(spark, STATE_PARTITIONS), f"{root}/log", ["speed"])
    pace = measures.measures()["pace"].from_source(messages)
    return jobs.drain_to_table(spark, pace.select("key", F.col("value_text").alias("value")), "pace")


ARCHIVED = ["speed", "heart_rate"]


def topic_archive(spark: Spark, sf: str) -> DataFrame:
    """Three topics in one log; a stream subscribes to two and stores each in a folder of its own."""
    telemetry = fixtures.telemetry(spark, sf)
    measured = live.speeds(telemetry)
    log = shared_path(spark, "topics")
    files.write_topics(
        to_topic(measured, "speed", F.col("speed"))
        .union(to_topic(live.paces(measured), "pace", F.col("pace")))
        .union(to_topic(telemetry, "heart_rate", F.col("heart_rate"))),
        log,
    )
    root = shared_path(spark, "archive")
    messages = files.stream_topics(jobs.stream_session(spark, STATE_PARTITIONS), log, ARCHIVED)
    jobs.drain(jobs.archive(messages, f"{root}/table", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/table").select("topic", "key", "value")


# --- sources and sinks ------------------------------------------------------------------------


def source_telemetry_files(spark: Spark, sf: str) -> DataFrame:
    """Telemetry through ``;``-separated files with a header, streamed and decoded."""
    path = shared_path(spark, "telemetry_csv")
    parts = F.split("value", ",")
    fields = [F.get(parts, F.lit(i)).alias(f) for i, f in enumerate(TELEMETRY_FIELDS)]
    encode_telemetry(spark, sf).select(*fields).write.csv(path, sep=";", header=True)
    messages = files.stream_telemetry_files(jobs.stream_session(spark, STATE_PARTITIONS), path)
    return jobs.drain_to_table(spark, from_messages(messages), "run_stats")


def sink_csv(spark: Spark, sf: str) -> DataFrame:
    """A stream to CSV files of one message column, read back."""
    windows = live.average_speeds(live.speeds(_stream(spark, sf)))
    rows = windows.select("runner_id", live.topic_time().alias("time"), "avg_speed")
    root = shared_path(spark, "avg_speed_csv")
    messages = to_topic(rows, "avg_speed", F.col("avg_speed")).select("value")
    jobs.drain(to_files(messages, f"{root}/table", f"{root}/checkpoint", format="csv"))
    return spark.read.schema("value string").options(**CSV).csv(f"{root}/table")


def sink_reset(spark: Spark, sf: str) -> DataFrame:
    """Rows of a live table, and of the same table emptied."""
    kept, emptied = shared_path(spark, "pace"), shared_path(spark, "pace")
    for path in (kept, emptied):
        files.write_table(pace(spark, sf), path)
    files.empty_table(spark, emptied, LIVE_TABLES["pace"])
    counts = [
        files.read_table(spark, path, LIVE_TABLES["pace"]).agg(F.count("*").alias("n")).withColumn("at", F.lit(at))
        for at, path in (("before", kept), ("after", emptied))
    ]
    rows = lambda at: F.max(F.when(F.col("at") == at, F.col("n")))
    return counts[0].union(counts[1]).agg(rows("after").alias("rows_after"), rows("before").alias("rows_before"))


def created_tables(spark: Spark, sf: str) -> DataFrame:
    """Live tables created without rows and then filled: their columns as the files have them, and rows."""
    root = shared_path(spark, "created")
    rows = {"pace": pace(spark, sf), "avg_speed": avg_speed_5s(spark, sf), "altitude_gain": elevation_5s(spark, sf)}
    found = []
    for name, filling in rows.items():
        schema, path = LIVE_TABLES[name], f"{root}/{name}"
        files.empty_table(spark, path, schema)
        columns = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type")) for c, t in spark.read.parquet(path).dtypes]
        conform(filling, schema).write.mode("append").parquet(path)
        filled = files.read_table(spark, path, schema).agg(F.count("*").alias("num_rows"))
        found.append(filled.select(F.lit(name).alias("table"), F.explode(F.array(*columns)).alias("c"), "num_rows"))
    return found[0].union(found[1]).union(found[2]).select("table", "c.*", "num_rows")


def sink_fanout(spark: Spark, sf: str) -> DataFrame:
    """One stream to a topic log, a typed table and CSV files, all three read back."""
    root = shared_path(spark, "fanout")
    measured = live.paces(live.speeds(_stream(spark, sf)))
    stream = measured.withColumns(
        {
            "key": F.col("runner_id").cast("string"),
            "value": encode(F.col("time"), F.col("pace")),
        }
    )
    target = fan_out(
        FileTarget(f"{root}/topic", ["key", "value"]),
        FileTarget(f"{root}/table", ["runner_id", "time", "pace"]),
        FileTarget(f"{root}/csv", ["value"], format="csv"),
    )
    jobs.drain_to_target(spark, stream, target, "fanout")
    topic = spark.read.parquet(f"{root}/topic").select("key", "value")
    table = spark.read.parquet(f"{root}/table").select(
        F.col("runner_id").cast("string").alias("key"),
        encode(F.col("time"), F.col("pace")).alias("value"),
    )
    csv = spark.read.schema("value string, batch int").options(**CSV).csv(f"{root}/csv")
    return (
        topic.withColumn("target", F.lit("topic"))
        .union(table.withColumn("target", F.lit("table")))
        .union(csv.select(F.lit(None), "value", F.lit("csv")))
    )


QUERIES = {
    "clean_time_limited": clean_time_limited,
    "clean_distance_limited": clean_distance_limited,
    "split_by_type": split_by_type,
    "normalise_names": normalised_names,
    "age_band": age_band,
    "distance_band": distance_band,
    "distance_km": distance_km,
    "duration_seconds": duration_seconds,
    "time_limit_hours": time_limit_hours,
    "speed_kmph": speed_kmph,
    "content_id": content_id,
    "row_id": row_id,
    "dense_row_id": dense_row_id,
    "source_bad_rows": source_bad_rows,
    "source_results_csv": source_results_csv,
    "q1_fastest_events": _of_distance(questions.fastest_events),
    "q2_athletes_per_band": _of_distance(questions.athletes_per_band),
    "q3_speed_by_band_and_age": _of_distance(questions.speed_by_band_and_age),
    "q4_most_attended_events": _of_distance(questions.most_attended_events),
    "q5_fastest_countries": _of_distance(questions.fastest_countries),
    "q6_athletes_per_country": _of_both(questions.athletes_per_country),
    "q7_athletes_per_age_group": _of_both(questions.athletes_per_age_group),
    "q8_distance_per_decade": distance_per_decade,
    "q9_most_improved": _of_distance(improvement.most_improved),
    "q10_speed_by_gender": _of_distance(questions.speed_by_gender),
    "weighted_history": _history,
    "weighted_history_bucketed": weighted_history_bucketed,
    "q9_bucketed": q9_bucketed,
    "q6_incremental": q6_incremental,
    "encode_telemetry": encode_telemetry,
    "decode_telemetry": decode_telemetry,
    "speed": speed,
    "pace": pace,
    "avg_speed_5s": avg_speed_5s,
    "speed_compare": speed_compare,
    "altitude_gain": altitude_gain,
    "elevation_5s": elevation_5s,
    "total_climb": total_climb,
    "latest_total": latest_total,
    "table_by_name": table_by_name,
    "latest_per_runner": latest_per_runner,
    "finish_estimate": finish_estimate,
    "stream_speed": stream_speed,
    "stream_pace": stream_pace,
    "stream_avg_speed_5s": stream_avg_speed_5s,
    "stream_compare": stream_compare,
    "stream_altitude_gain": stream_altitude_gain,
    "stream_elevation_5s": stream_elevation_5s,
    "stream_total_climb": stream_total_climb,
    "stream_finish_estimate": stream_finish_estimate,
    "stream_batches_avg_speed": stream_batches_avg_speed,
    "stream_batches_compare": stream_batches_compare,
    "stream_batches_elevation": stream_batches_elevation,
    "stream_late_rows": stream_late_rows,
    "stream_late_counts": stream_late_counts,
    "stream_open_windows": stream_open_windows,
    "stream_restart": stream_restart,
    "stream_total_replayed": stream_total_replayed,
    "stream_total_per_insert": stream_total_per_insert,
    "chained_topics": chained_topics,
    "topic_archive": topic_archive,
    "source_telemetry_files": source_telemetry_files,
    "sink_csv": sink_csv,
    "sink_reset": sink_reset,
    "created_tables": created_tables,
    "sink_fanout": sink_fanout,
}
