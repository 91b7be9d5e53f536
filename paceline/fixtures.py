"""Race results and telemetry from the given test tables (see FIXTURES.md)."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.operators.clean import conform, distance_limited, time_limited, with_row_id
from paceline.schemas import DISTANCE_LIMITED, TIME_LIMITED
from paceline.session import shared_path
from paceline.sources.files import read_table, write_table

REFERENCE_YEAR = 2001
RACE_KM = 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _digits(number: str, width: int) -> Column:
    return F.expr(f"lpad(cast({number} as string), {width}, '0')")


# Event lengths by kind of event; the kind goes by the line number, the length by the part.
KILOMETRES = ["21", "42.195", "50", "80", "100", "161", "250", "1500", "7000"]
MILES = ["26.2", "50", "100"]
HOURS = ["6", "12", "24"]
LENGTHS = [
    [f"{n}km" for n in KILOMETRES],
    [f"{n}mi" for n in MILES],
    [f"{n}h" for n in HOURS],
    [None if part % 10 == 0 else f"{1 + part % 6}d" for part in range(30)],
]


def _length() -> Column:
    kind = F.expr("greatest(l_linenumber - 4, 0)")
    sizes = F.array(*[F.lit(len(texts)) for texts in LENGTHS])
    texts = F.array(*[F.array(*[F.lit(t) for t in texts]) for texts in LENGTHS])
    return F.get(F.get(texts, kind), (F.col("l_partkey") % F.get(sizes, kind)).cast("int"))


def _performance() -> Column:
    clock = F.concat(
        _digits("(_n % 86400) div 3600", 2), F.lit(":"),
        _digits("(_n % 3600) div 60", 2), F.lit(":"),
        _digits("_n % 60", 2), F.lit(" h"),
    )
    days = F.when(F.col("_n") >= 86400, F.concat(F.expr("string(_n div 86400)"), F.lit("d ")))
    crossed = F.concat(
        F.expr("string(_v div 1000)"), F.lit("."), _digits("_v % 1000", 3),
        F.when(F.col("l_suppkey") % 3 == 0, " mi").otherwise(" km"),
    )
    return (
        F.when(F.col("l_suppkey") % 50 == 0, "n/a")
        .when(F.col("l_linenumber") <= 5, F.concat(F.coalesce(days, F.lit("")), clock))
        .otherwise(crossed)
    )


def race_results_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw results, all text, with normalised names. Join strategies are left to Spark."""
    lineitem = table(spark, sf_dir, "lineitem").withColumns(
        {
            "_v": F.expr("bigint(floor(l_extendedprice))"),
            "_n": F.expr("bigint(floor(l_extendedprice)) + 3600"),
            "_w": F.expr("bigint(floor(5000 + l_extendedprice / 10))"),
        }
    )
    rows = (
        lineitem.join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    )
    # In thousandths; suppliers with an even number write a decimal point.
    point = F.when(F.col("l_suppkey") % 2 == 0, ".").otherwise("")
    speed = F.when(F.col("l_discount") == 0, "0").otherwise(
        F.concat(F.expr("string(_w div 1000)"), point, _digits("_w % 1000", 3))
    )
    return rows.select(
        F.year("o_orderdate").cast("string").alias("year_of_event"),
        F.date_format("o_orderdate", "dd.MM.yyyy").alias("event_dates"),
        F.col("p_brand").alias("event_name"),
        _length().alias("event_distance/length"),
        (F.lit(100) + F.col("p_size")).cast("string").alias("event_number_of_finishers"),
        _performance().alias("athlete_performance"),
        F.expr("if(c_custkey % 4 = 0, null, concat('Club ', string(c_custkey % 20)))").alias("athlete_club"),
        F.col("n_name").alias("athlete_country"),
        F.expr("if(c_custkey % 10 = 0, null, concat(string(1900 + c_custkey % 110), '.0'))").alias(
            "athlete_year_of_birth"
        ),
        F.expr(
            "case when c_custkey % 7 = 0 then 'X' when c_custkey % 7 <= 3 then 'F' else 'M' end"
        ).alias("athlete_gender"),
        F.lit("X").alias("athlete_age_category"),
        speed.alias("athlete_average_speed"),
        F.col("c_custkey").cast("string").alias("athlete_id"),
    )


# Cleaned tables already stored, by application and source.
_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, clean, schema) -> DataFrame:
    """A cleaned table, written to the shared folder by the first query that needs it.

    The questions are asked of stored tables, as cleaning is done once: they then read only their
    columns, filters reach the files, and no question repeats the joins behind the raw results.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = shared_path(spark, name)
        write_table(conform(with_row_id(clean(race_results_raw(spark, sf_dir))), schema), path)
        _STORED[key] = path
    return read_table(spark, _STORED[key], schema)


def time_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "running_time_constrained", time_limited, TIME_LIMITED)


def distance_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(
        spark, sf_dir, "running_distance_constrained", distance_limited, DISTANCE_LIMITED
    )


def run_stats(events: DataFrame) -> DataFrame:
    """Telemetry of ten runners, one row a second each. Stateless, so it serves streams as well."""
    return events.selectExpr(
        "event_id % 10 as runner_id",
        "timestamp_seconds(unix_timestamp(timestamp '2024-01-01 00:00:00') + event_id div 10) as time",
        "45.0D as latitude",
        "15.0D as longitude",
        "float(floor(value * 4) / 4) as altitude",
        "float((event_id div 10) * 2.5D) as distance",
        "int(100 + user_id % 80) as heart_rate",
        "float(if(event_id % 97 = 0, 0D, 2 + (event_id % 13) * 0.25D)) as speed",
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stats(table(spark, sf_dir, "events"))


def stream_telemetry(session: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream over whatever event files the folder holds."""
    schema = table(session, sf_dir, "events").schema
    events = session.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return run_stats(events.parquet(sf_dir))
