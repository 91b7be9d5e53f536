"""The same results in plain SQL over the test tables, written apart from the Spark plans.

The questions follow the definitions literally: a rank window over the whole band, two self-joins
for the most improved. Means and sums are taken over decimals where the definition says double, so
that both engines add up exactly and agree to the last bit.
"""

RAW = """
raw_source AS (
  SELECT *, CAST(floor(l_extendedprice) AS BIGINT) AS v,
         CAST(floor(l_extendedprice) AS BIGINT) + 3600 AS n,
         CAST(floor(5000 + l_extendedprice / 10) AS BIGINT) AS w
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
),
raw AS (
  SELECT
    CAST(year(o_orderdate) AS VARCHAR) AS year_of_event,
    strftime(o_orderdate, '%d.%m.%Y') AS event_dates,
    p_brand AS event_name,
    CASE
      WHEN l_linenumber <= 4 THEN
        (['21','42.195','50','80','100','161','250','1500','7000'])[1 + l_partkey % 9] || 'km'
      WHEN l_linenumber = 5 THEN (['26.2','50','100'])[1 + l_partkey % 3] || 'mi'
      WHEN l_linenumber = 6 THEN (['6','12','24'])[1 + l_partkey % 3] || 'h'
      WHEN l_partkey % 10 = 0 THEN NULL
      ELSE CAST(1 + l_partkey % 6 AS VARCHAR) || 'd'
    END AS "event_distance/length",
    CAST(100 + p_size AS VARCHAR) AS event_number_of_finishers,
    CASE
      WHEN l_suppkey % 50 = 0 THEN 'n/a'
      WHEN l_linenumber <= 5 THEN
        CASE WHEN n >= 86400 THEN CAST(n // 86400 AS VARCHAR) || 'd ' ELSE '' END
        || lpad(CAST(n % 86400 // 3600 AS VARCHAR), 2, '0') || ':'
        || lpad(CAST(n % 3600 // 60 AS VARCHAR), 2, '0') || ':'
        || lpad(CAST(n % 60 AS VARCHAR), 2, '0') || ' h'
      ELSE CAST(v // 1000 AS VARCHAR) || '.' || lpad(CAST(v % 1000 AS VARCHAR), 3, '0')
        || CASE WHEN l_suppkey % 3 = 0 THEN ' mi' ELSE ' km' END
    END AS athlete_performance,
    CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Club ' || CAST(c_custkey % 20 AS VARCHAR) END
      AS athlete_club,
    n_name AS athlete_country,
    CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(1900 + c_custkey % 110 AS VARCHAR) || '.0' END
      AS athlete_year_of_birth,
    CASE WHEN c_custkey % 7 = 0 THEN 'X' WHEN c_custkey % 7 <= 3 THEN 'F' ELSE 'M' END
      AS athlete_gender,
    CASE
      WHEN l_discount = 0 THEN '0'
      WHEN l_suppkey % 2 = 0 THEN
        CAST(w // 1000 AS VARCHAR) || '.' || lpad(CAST(w % 1000 AS VARCHAR), 3, '0')
      ELSE CAST(w AS VARCHAR)
    END AS athlete_average_speed,
    CAST(c_custkey AS VARCHAR) AS athlete_id
  FROM raw_source
)"""


def km(text: str) -> str:
    number = f"CAST(TRY_CAST(regexp_extract({text}, '([0-9]+(.[0-9]+)?)', 1) AS FLOAT) AS DOUBLE)"
    return (
        f"round(CASE WHEN {text} LIKE '%km%' THEN {number} "
        f"WHEN {text} LIKE '%mi%' THEN {number} * CAST(1.609344 AS DOUBLE) ELSE 0 END, 4)"
    )


def seconds(text: str) -> str:
    def part(group: int) -> str:
        clock = "([0-9]+):([0-9]{2}):([0-9]{2})"
        return f"TRY_CAST(regexp_extract({text}, '{clock}', {group}) AS INTEGER)"

    return (
        f"(CASE WHEN {text} LIKE '%d%' THEN TRY_CAST(regexp_extract({text}, '([0-9]+)d', 1) AS INTEGER) "
        f"ELSE 0 END) * 86400 + {part(1)} * 3600 + {part(2)} * 60 + {part(3)}"
    )


def hours(text: str) -> str:
    number = f"TRY_CAST(regexp_extract({text}, '([0-9]+)', 1) AS INTEGER)"
    return (
        f"(CASE WHEN {text} LIKE '%d%' THEN {number} ELSE 0 END) * 24 "
        f"+ (CASE WHEN {text} LIKE '%h%' THEN {number} ELSE 0 END)"
    )


def label(number: str, bounds: list[tuple[int, int]]) -> str:
    whens = " ".join(f"WHEN {number} >= {a} AND {number} < {b} THEN '{a}-{b}'" for a, b in bounds)
    return f"CASE WHEN {number} IS NULL OR {number} <= 0 THEN NULL {whens} ELSE 'None' END"


AGES = [(17, 30), (30, 45), (45, 120)]
LENGTHS = [(0, 40), (40, 65), (65, 90), (90, 120), (120, 200), (200, 1000), (1000, 6000)]
LENGTH = '"event_distance/length"'
IS_TIME = f"({LENGTH} LIKE '%d%' OR {LENGTH} LIKE '%h%')"
ALWAYS = "CAST(TRY_CAST(athlete_average_speed AS FLOAT) AS DOUBLE) / 1000"
MIXED = (
    "CASE WHEN TRY_CAST(athlete_average_speed AS DOUBLE) > 50 "
    "THEN TRY_CAST(athlete_average_speed AS DOUBLE) / 1000 "
    "ELSE TRY_CAST(athlete_average_speed AS DOUBLE) END"
)
AGE = "CAST(year_of_event AS INTEGER) - CAST(CAST(athlete_year_of_birth AS DOUBLE) AS INTEGER)"
SHARED = (
    "CAST(year_of_event AS INTEGER) AS year_of_event, event_dates, event_name, "
    "CAST(event_number_of_finishers AS INTEGER) AS event_number_of_finishers, athlete_club, "
    f"athlete_country, athlete_gender, CAST(athlete_id AS BIGINT) AS athlete_id, {AGE} AS athlete_age"
)

TIMED = f"""
timed AS (
  SELECT *, {label("athlete_age", AGES)} AS age_group FROM (
    SELECT {SHARED}, CAST(CAST(athlete_year_of_birth AS DOUBLE) AS INTEGER) AS athlete_year_of_birth,
      {hours(LENGTH)} AS time_limit_h, {km("athlete_performance")} AS distance_crossed_km,
      {ALWAYS} AS athlete_average_speed_kmph
    FROM raw WHERE {IS_TIME})
)"""

DIST = f"""
dist AS (
  SELECT *, {label("athlete_age", AGES)} AS age_group,
    {label("distance_km", LENGTHS)} AS distance_group_km
  FROM (
    SELECT {SHARED}, CAST(athlete_year_of_birth AS DOUBLE) AS athlete_year_of_birth,
      athlete_performance AS time_spent, {km(LENGTH)} AS distance_km,
      {seconds("athlete_performance")} AS time_spent_s, {MIXED} AS athlete_average_speed_kmph
    FROM raw WHERE NOT {IS_TIME})
)"""


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(p.strip() for p in parts) + " "


def _counted(columns: str, where: str = "true") -> str:
    return _with(RAW) + f"SELECT {columns}, count(*) AS num_rows FROM raw WHERE {where} GROUP BY ALL"


MEAN = (
    "CAST(sum(CAST(athlete_average_speed_kmph AS DECIMAL(18,9))) AS DOUBLE) "
    "/ count(athlete_average_speed_kmph)"
)
LONG = "distance_group_km IS NOT NULL AND distance_group_km != '0-40'"
MOVED = "athlete_average_speed_kmph != 0"

Q9 = """,
ends AS (
  SELECT athlete_id, distance_group_km, min(event_dates) AS first_day, max(event_dates) AS last_day
  FROM dist GROUP BY athlete_id, distance_group_km
),
pairs AS (
  SELECT e.athlete_id, e.distance_group_km,
    a.athlete_average_speed_kmph AS avg_speed_first_marathon,
    b.athlete_average_speed_kmph AS avg_speed_last_marathon,
    (b.athlete_average_speed_kmph - a.athlete_average_speed_kmph)
      / a.athlete_average_speed_kmph * 100 AS improvement_percentage
  FROM ends e
  JOIN dist a ON a.athlete_id = e.athlete_id AND a.distance_group_km = e.distance_group_km
    AND a.event_dates = e.first_day
  JOIN dist b ON b.athlete_id = e.athlete_id AND b.distance_group_km = e.distance_group_km
    AND b.event_dates = e.last_day
  WHERE a.athlete_average_speed_kmph != 0 AND b.athlete_average_speed_kmph != 0
    AND e.distance_group_km != '0-40'
)
SELECT * FROM (
  SELECT *, dense_rank() OVER (
    PARTITION BY distance_group_km ORDER BY improvement_percentage DESC) AS rank_by_improvement
  FROM pairs)
WHERE rank_by_improvement <= 10"""

RACE_KM = 21
REFERENCE_YEAR = 2001
# Means of a few races often end in exactly half a unit of the fourth decimal. The definition rounds
# such decimals up, as is done here; rounding the double directly would go by its binary error.
HISTORY = f"""
history AS (
  SELECT runner_id, CAST(round(CAST(
      CAST(sum(v * weight) AS DOUBLE) / sum(weight) AS DECIMAL(18,9)), 4) AS DOUBLE) AS average_speed
  FROM (
    SELECT athlete_id AS runner_id, CAST(athlete_average_speed_kmph AS DECIMAL(18,9)) AS v,
      ({REFERENCE_YEAR} - min(year_of_event) OVER (PARTITION BY athlete_id) + 1)
        - ({REFERENCE_YEAR} - year_of_event) AS weight
    FROM dist WHERE distance_km = {RACE_KM} AND year_of_event <= {REFERENCE_YEAR})
  GROUP BY runner_id
)"""

RUN = """
run AS (
  SELECT event_id % 10 AS runner_id,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id // 10) AS time,
    CAST(45.0 AS DOUBLE) AS latitude, CAST(15.0 AS DOUBLE) AS longitude,
    CAST(floor(value * 4) / 4 AS FLOAT) AS altitude,
    CAST((event_id // 10) * CAST(2.5 AS DOUBLE) AS FLOAT) AS distance,
    CAST(100 + user_id % 80 AS INTEGER) AS heart_rate,
    CAST(CASE WHEN event_id % 97 = 0 THEN 0 ELSE 2 + (event_id % 13) * CAST(0.25 AS DOUBLE) END
      AS FLOAT) AS speed
  FROM events
)"""

TEXT_TIME = "strftime(time, '%Y-%m-%d %H:%M:%S')"
PACES = """
paces AS (
  SELECT runner_id, time,
    CASE WHEN speed = 0 THEN NULL ELSE round(CAST(16.666666667 AS DOUBLE) / speed, 4) END AS pace
  FROM run
)"""
AVERAGES = """
averages AS (
  SELECT runner_id, time_bucket(INTERVAL '5 seconds', time) + INTERVAL '5 seconds' AS window_end,
    round(avg(speed), 4) AS avg_speed
  FROM run GROUP BY ALL
)"""
COMPARED = """
compared AS (
  SELECT r.runner_id, r.time, a.window_end,
    CASE WHEN r.speed > CAST(a.avg_speed AS FLOAT) THEN 'faster' ELSE 'slower' END AS comparison
  FROM run r JOIN averages a
    ON a.runner_id = r.runner_id AND a.window_end - INTERVAL '1 second' = r.time
)"""
GAINS = """
gains AS (
  SELECT c.runner_id, c.time,
    round(CASE WHEN c.altitude > p.altitude THEN c.altitude - p.altitude ELSE 0 END, 4)
      AS altitude_gain
  FROM run c JOIN run p
    ON p.runner_id = c.runner_id AND p.time + INTERVAL '1 second' = c.time
)"""
CLIMBS = """
climbs AS (
  SELECT runner_id, time_bucket(INTERVAL '5 seconds', time) + INTERVAL '5 seconds' AS time,
    round(sum(CAST(altitude_gain AS DOUBLE)), 4) AS value
  FROM gains GROUP BY ALL
)"""
TOTALS = """
totals AS (
  SELECT runner_id, time, sum(value) OVER (
    PARTITION BY runner_id ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM climbs
)"""
ESTIMATES = f"""
estimates AS (
  SELECT runner_id, time,
    CASE WHEN average_speed = 0 THEN NULL ELSE
      round((CAST({RACE_KM * 1000} AS FLOAT) - distance)
        / (average_speed * (CAST(1000 AS DOUBLE) / 60)), 4) END AS estimated_min
  FROM run LEFT JOIN history USING (runner_id)
)"""

# A window is out once the watermark, the latest time less the delay, has passed its end.
OUT = "{end} <= (SELECT max(time) FROM run) - INTERVAL '{delay} second'"


def messages() -> str:
    fields = [TEXT_TIME] + [
        f"coalesce(CAST({c} AS VARCHAR), '')"
        for c in ("latitude", "longitude", "altitude", "distance", "heart_rate", "speed")
    ]
    return " || ',' || ".join(fields)


CLEAN_TIME = _with(RAW, TIMED) + "SELECT * FROM timed"
CLEAN_DISTANCE = _with(RAW, DIST) + "SELECT * FROM dist"
TELEMETRY = (
    _with(RUN) + "SELECT runner_id, time, latitude, longitude, altitude, distance, heart_rate, speed FROM run"
)
SPEED_TOPIC = (
    _with(RUN)
    + f"SELECT CAST(runner_id AS VARCHAR) AS key, {TEXT_TIME} || ',' || CAST(speed AS VARCHAR) AS value FROM run"
)
PACE = _with(RUN, PACES) + "SELECT * FROM paces"
AVERAGE = (
    _with(RUN, AVERAGES)
    + "SELECT runner_id, window_end - INTERVAL '1 second' AS topic_time, window_end AS time, avg_speed FROM averages"
)
COMPARE = _with(RUN, AVERAGES, COMPARED) + "SELECT runner_id, time, comparison FROM compared"
GAIN = _with(RUN, GAINS) + "SELECT * FROM gains"
CLIMB = _with(RUN, GAINS, CLIMBS) + "SELECT * FROM climbs"
TOTAL = _with(RUN, GAINS, CLIMBS, TOTALS)
ESTIMATE = _with(RAW, DIST, HISTORY, RUN, ESTIMATES) + "SELECT * FROM estimates"
RAW_COLUMNS = [
    "year_of_event", "event_dates", "event_name", LENGTH, "event_number_of_finishers",
    "athlete_performance", "athlete_club", "athlete_country", "athlete_year_of_birth",
    "athlete_gender", "athlete_average_speed", "athlete_id",
]
CONTENT = " || chr(31) || ".join(f"coalesce({c}, '\\N')" for c in RAW_COLUMNS)

_FIELDS = [f"coalesce({c}, '')" for c in [*RAW_COLUMNS[:10], "'X'", *RAW_COLUMNS[10:]]]
LINE = " || ',' || ".join(_FIELDS)
SHORT_LINE = " || ',' || ".join(_FIELDS[:5])

ORACLE = {
    "clean_time_limited": CLEAN_TIME,
    "clean_distance_limited": CLEAN_DISTANCE,
    "split_by_type": _counted(
        f"CASE WHEN {IS_TIME} THEN 'time' WHEN NOT {IS_TIME} THEN 'distance' ELSE 'neither' END AS kind"
    ),
    "normalise_names": _with(RAW) + "SELECT * FROM raw",
    "age_band": _counted(f"{AGE} AS athlete_age, {label(f'({AGE})', AGES)} AS age_group"),
    "distance_band": _counted(
        f"{km(LENGTH)} AS distance_km, {label(km(LENGTH), LENGTHS)} AS distance_group_km"
    ),
    "distance_km": _counted(f"{LENGTH} AS length, {km(LENGTH)} AS km"),
    "duration_seconds": _counted(f"athlete_performance, {seconds('athlete_performance')} AS seconds"),
    "time_limit_hours": _counted(f"{LENGTH} AS length, {hours(LENGTH)} AS hours", IS_TIME),
    "speed_kmph": _counted(
        f"athlete_average_speed, {ALWAYS} AS time_limited_kmph, {MIXED} AS distance_limited_kmph"
    ),
    "content_id": _with(RAW) + f"SELECT md5({CONTENT}) AS content_id FROM raw",
    "row_id": _with(RAW, DIST) + "SELECT count(*) AS num_rows, count(*) AS num_ids FROM dist",
    "dense_row_id": _with(RAW, DIST)
    + "SELECT count(*) AS num_rows, count(*) AS num_ids, CAST(0 AS BIGINT) AS first_id, count(*) - 1 AS last_id FROM dist",
    "source_bad_rows": _with(RAW)
    + f"""SELECT CASE WHEN athlete_gender = 'X' OR athlete_club IS NULL THEN 'bad' ELSE 'good' END AS kind,
      CASE WHEN athlete_gender = 'X' THEN {SHORT_LINE} WHEN athlete_club IS NULL THEN {LINE} || ',more' ELSE {LINE} END AS line FROM raw""",
    "source_results_csv": CLEAN_DISTANCE,
    "q1_fastest_events": _with(RAW, DIST)
    + f"""SELECT * FROM (
      SELECT *, dense_rank() OVER (
        PARTITION BY distance_group_km ORDER BY avg_athlete_speed_kmph DESC) AS rank
      FROM (
        SELECT year_of_event, event_name, distance_group_km, distance_km, count(*) AS athlete_num,
          {MEAN} AS avg_athlete_speed_kmph
        FROM dist WHERE {LONG} AND {MOVED}
        GROUP BY year_of_event, event_name, distance_group_km, distance_km HAVING count(*) > 10))
      WHERE rank <= 10""",
    "q2_athletes_per_band": _with(RAW, DIST)
    + f"SELECT distance_group_km, count(*) AS num_athletes FROM dist WHERE {LONG} GROUP BY ALL",
    "q3_speed_by_band_and_age": _with(RAW, DIST)
    + f"""SELECT distance_group_km, age_group, count(*) AS athlete_num, {MEAN} AS avg_athlete_speed_kmph
      FROM dist WHERE distance_group_km != '0-40' AND age_group IS NOT NULL AND age_group != 'None'
        AND athlete_average_speed_kmph > 0
      GROUP BY distance_group_km, age_group""",
    "q4_most_attended_events": _with(RAW, DIST)
    + """SELECT * FROM (
      SELECT year_of_event, event_name, distance_group_km, count(*) AS athlete_num,
        dense_rank() OVER (PARTITION BY distance_group_km ORDER BY count(*) DESC) AS rank
      FROM dist WHERE distance_group_km IS NOT NULL
      GROUP BY year_of_event, event_name, distance_group_km)
      WHERE rank <= 10""",
    "q5_fastest_countries": _with(RAW, DIST)
    + f"""SELECT * FROM (
      SELECT *, dense_rank() OVER (
        PARTITION BY distance_group_km ORDER BY avg_athlete_speed_kmph DESC) AS rank
      FROM (
        SELECT distance_group_km, athlete_country, {MEAN} AS avg_athlete_speed_kmph
        FROM dist WHERE {LONG} AND {MOVED} GROUP BY distance_group_km, athlete_country))
      WHERE rank <= 10""",
    "q6_athletes_per_country": _with(RAW, DIST, TIMED)
    + """SELECT athlete_country AS country, count(athlete_id) AS num_of_athletes FROM (
      SELECT athlete_country, athlete_id FROM timed
      UNION SELECT athlete_country, athlete_id FROM dist) GROUP BY athlete_country""",
    "q7_athletes_per_age_group": _with(RAW, DIST, TIMED)
    + """SELECT age_group, count(athlete_id) AS num_of_athletes FROM (
      SELECT age_group, athlete_id FROM timed WHERE age_group IS NOT NULL AND age_group != 'None'
      UNION
      SELECT age_group, athlete_id FROM dist WHERE age_group IS NOT NULL AND age_group != 'None')
      GROUP BY age_group""",
    "q8_distance_per_decade": _with(RAW, TIMED)
    + """SELECT CAST(make_date(CAST(floor((year_of_event - 1) / 10) * 10 AS INTEGER), 1, 1) AS VARCHAR)
        AS decade_start,
      CAST(sum(CAST(distance_crossed_km AS DECIMAL(18,4))) AS DOUBLE) AS total_distance
      FROM timed GROUP BY 1""",
    "q9_most_improved": (_with(RAW, DIST).rstrip() + Q9),
    "q10_speed_by_gender": _with(RAW, DIST)
    + f"""SELECT distance_group_km, athlete_gender, {MEAN} AS avg_athlete_speed_kmph
      FROM dist WHERE distance_group_km != '0-40' AND {MOVED} AND athlete_gender IN ('F', 'M')
      GROUP BY distance_group_km, athlete_gender""",
    "weighted_history": _with(RAW, DIST, HISTORY) + "SELECT * FROM history",
    "weighted_history_bucketed": _with(RAW, DIST, HISTORY) + "SELECT * FROM history",
    "encode_telemetry": _with(RUN)
    + f"SELECT CAST(runner_id AS VARCHAR) AS key, {messages()} AS value FROM run",
    "decode_telemetry": TELEMETRY,
    "speed": SPEED_TOPIC,
    "pace": PACE,
    "avg_speed_5s": AVERAGE,
    "speed_compare": COMPARE,
    "altitude_gain": GAIN,
    "elevation_5s": CLIMB,
    "total_climb": TOTAL + "SELECT * FROM totals",
    "latest_total": TOTAL + "SELECT * FROM totals ORDER BY time DESC, runner_id LIMIT 1",
    "table_by_name": TOTAL + "SELECT runner_id, time, round(value, 4) AS value FROM totals ORDER BY time DESC, runner_id LIMIT 1",
    "latest_per_runner": TOTAL
    + "SELECT runner_id, max(time) AS time, arg_max(value, time) AS value FROM totals GROUP BY runner_id",
    "finish_estimate": ESTIMATE,
    "stream_speed": SPEED_TOPIC,
    "stream_pace": PACE,
    "stream_avg_speed_5s": AVERAGE + " WHERE " + OUT.format(end="window_end", delay=1),
    "stream_compare": COMPARE + " WHERE " + OUT.format(end="window_end", delay=1),
    "stream_altitude_gain": GAIN,
    "stream_elevation_5s": CLIMB + " WHERE " + OUT.format(end="climbs.time", delay=5),
    "stream_total_climb": _with(RUN, GAINS, CLIMBS)
    + "SELECT runner_id, max(time) AS time, round(sum(value), 4) AS value FROM climbs WHERE "
    + OUT.format(end="climbs.time", delay=5)
    + " GROUP BY runner_id",
    "stream_total_replayed": _with(RUN, GAINS, CLIMBS)
    + "SELECT runner_id, max(time) AS time, round(sum(value), 4) AS value FROM climbs WHERE "
    + OUT.format(end="climbs.time", delay=5)
    + " GROUP BY runner_id",
    "stream_total_per_insert": TOTAL + "SELECT runner_id, time, round(value, 4) AS value FROM totals WHERE "
    + OUT.format(end="totals.time", delay=5),
    "stream_finish_estimate": ESTIMATE,
    # In order of time no row is late, so batches change nothing in what comes out.
    "stream_batches_avg_speed": AVERAGE + " WHERE " + OUT.format(end="window_end", delay=1),
    "stream_batches_compare": COMPARE + " WHERE " + OUT.format(end="window_end", delay=1),
    "stream_batches_elevation": CLIMB + " WHERE " + OUT.format(end="climbs.time", delay=5),
    # Windows before the middle end before the watermark that the second half has left.
    "stream_late_rows": AVERAGE
    + " WHERE " + OUT.format(end="window_end", delay=1)
    + " AND epoch(window_end) > (SELECT (epoch(min(time))::BIGINT + epoch(max(time))::BIGINT) // 2 // 5 * 5 FROM run)",
    "stream_late_counts": _with(RUN).rstrip() + """,
      half AS (SELECT time >= make_timestamp((epoch(min(time) OVER ())::BIGINT + epoch(max(time) OVER ())::BIGINT) // 2 // 5 * 5 * 1000000) AS later FROM run)
      SELECT CASE WHEN later THEN 'first' ELSE 'second' END AS batch, count(*) AS rows_read,
        CASE WHEN later THEN count(*) ELSE 0 END AS rows_kept, CASE WHEN later THEN 0 ELSE count(*) END AS rows_dropped
      FROM half GROUP BY later""",
    "stream_open_windows": AVERAGE.replace("SELECT runner_id, window_end - INTERVAL '1 second' AS topic_time, window_end AS time, avg_speed",
                                           "SELECT runner_id, window_end AS time")
    + " WHERE NOT " + OUT.format(end="window_end", delay=1),
    "stream_restart": _with(RUN)
    + "SELECT runner_id, time, speed, target FROM run, (VALUES ('one'), ('two'), ('three')) AS t(target)",
    "chained_topics": _with(RUN, PACES)
    + f"SELECT CAST(runner_id AS VARCHAR) AS key, {TEXT_TIME} || ',' || CAST(pace AS VARCHAR) AS value FROM paces",
    "topic_archive": _with(RUN)
    + f"""SELECT 'speed' AS topic, CAST(runner_id AS VARCHAR) AS key,
        {TEXT_TIME} || ',' || CAST(speed AS VARCHAR) AS value FROM run
      UNION ALL
      SELECT 'heart_rate', CAST(runner_id AS VARCHAR),
        {TEXT_TIME} || ',' || CAST(heart_rate AS VARCHAR) FROM run""",
    "source_telemetry_files": TELEMETRY.replace("SELECT runner_id,", "SELECT CAST(1 AS BIGINT) AS runner_id,"),
    "sink_csv": _with(RUN, AVERAGES)
    + """SELECT strftime(window_end - INTERVAL '1 second', '%Y-%m-%d %H:%M:%S') || ','
        || CAST(avg_speed AS VARCHAR) AS value FROM averages WHERE """
    + OUT.format(end="window_end", delay=1),
    "sink_reset": _with(RUN) + "SELECT CAST(0 AS BIGINT) AS rows_after, count(*) AS rows_before FROM run",
    "created_tables": _with(RUN, PACES, AVERAGES, GAINS, CLIMBS)
    + """SELECT t."table", c."column", c.type, t.num_rows FROM (
        SELECT 'pace' AS "table", count(*) AS num_rows FROM paces
        UNION ALL SELECT 'avg_speed', count(*) FROM averages
        UNION ALL SELECT 'altitude_gain', count(*) FROM climbs) t
      JOIN (VALUES ('pace', 'pace'), ('avg_speed', 'avg_speed'), ('altitude_gain', 'value')) v("table", value) USING ("table"),
      LATERAL (VALUES ('runner_id', 'bigint'), ('time', 'timestamp'), (v.value, 'double')) AS c("column", type)""",
    "sink_fanout": _with(RUN, PACES)
    + f"""SELECT target, CASE WHEN target = 'csv' THEN NULL ELSE CAST(runner_id AS VARCHAR) END AS key,
        {TEXT_TIME} || ',' || CAST(pace AS VARCHAR) AS value
      FROM paces, (VALUES ('topic'), ('table'), ('csv')) AS t(target)""",
}
ORACLE["q6_incremental"] = ORACLE["q6_athletes_per_country"]
ORACLE["q9_bucketed"] = ORACLE["q9_most_improved"]
