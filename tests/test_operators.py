"""Operators against brute force, on small fixtures in which one key holds most of the rows."""

import itertools
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from paceline.operators.aggregates import exact_avg, exact_by, exact_sum, recency_weighted_mean
from paceline.operators.joins import join_same
from paceline.operators.ranking import repeat_rows, top_dense_rank
from paceline.operators.running import running_total
from paceline.plans import live
from paceline.plans.improvement import most_improved
from paceline.schemas import TELEMETRY


def test_top_ranks_with_ties_and_a_hot_group(spark):
    random.seed(1)
    rows = [("hot", random.randint(0, 30), i) for i in range(3000)]
    rows += [(random.choice("abc"), random.randint(0, 5), i) for i in range(300)]
    rows += [("a", None, -1), (None, 3, -2), (None, 2, -3)]
    frame = spark.createDataFrame(rows, "g string, v int, id int")
    found = top_dense_rank(frame, "g", "v", "rank", 3).collect()
    values = defaultdict(set)
    for g, v, _ in rows:
        values[g].add(v)

    def rank(g, v):
        order = sorted(values[g], key=lambda x: (x is not None, -(x or 0)))
        return order.index(v) + 1

    expected = [(g, v, i, rank(g, v)) for g, v, i in rows if rank(g, v) <= 3]
    assert Counter(map(tuple, found)) == Counter(expected)


def test_repeat_rows_in_blocks(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 7), ("c", 20)], "k string, n bigint")
    found = Counter(r.k for r in repeat_rows(frame, "n", block=10).collect())
    assert found == {"a": 1, "b": 7, "c": 20}


def test_copies_of_one_row_are_written_by_many_tasks(spark):
    frame = spark.range(1).select(F.lit("a").alias("k"), F.lit(10_000).cast("bigint").alias("n"))
    spread = repeat_rows(frame, "n", block=100).withColumn("p", F.spark_partition_id())
    assert spread.count() == 10_000
    assert spread.select("p").distinct().count() > 1 or spark.conf.get("spark.sql.adaptive.enabled") == "true"
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "_block" in plan.split("Exchange hashpartitioning", 1)[1].split("\n", 1)[0]


def test_join_same_matches_nulls_and_infers_no_filter(spark):
    left = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    right = spark.createDataFrame([(1, "p"), (None, "q")], "k int, b string")
    joined = join_same(left, right, ["k"])
    assert {tuple(r) for r in joined.collect()} == {(1, "x", "p"), (None, "y", "q")}
    assert "isnotnull" not in joined._jdf.queryExecution().toString().lower()


def test_exact_means_do_not_depend_on_order(spark):
    random.seed(2)
    values = [random.randint(1, 50_000) / 1000 for _ in range(2000)]
    results = set()
    for parts in (1, 3, 7):
        frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        results.add(tuple(frame.agg(exact_avg(F.col("v")), exact_sum(F.col("v"))).first()))
        random.shuffle(values)
    assert len(results) == 1
    total = sum(Fraction(str(v)) for v in values)
    assert results.pop() == (float(total) / 2000, float(total))


@pytest.mark.parametrize("value", [1.0000000004, 10.123456789012345, 0.1234567890123456, 1e-9, 3.3e-14, -2.5])
def test_exact_means_keep_all_digits(spark, value):
    frame = spark.createDataFrame([(value,)] * 2, "v double")
    assert tuple(frame.agg(exact_avg(F.col("v")), exact_sum(F.col("v"))).first()) == (value, 2 * value)


def test_values_out_of_range_are_added_by_themselves(spark):
    values = [0.1] * 10 + [1e300]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert frame.agg(exact_sum(F.col("v"))).first()[0] == 1e300
    assert math.isnan(frame.union(spark.createDataFrame([(math.nan,)], "v double")).agg(exact_sum(F.col("v"))).first()[0])
    tiny = spark.createDataFrame([(1e-310,), (1.0,)], "v double")
    assert tiny.agg(exact_sum(F.col("v"))).first()[0] == 1.0
    assert tiny.filter("v < 1").agg(exact_sum(F.col("v"))).first()[0] == 1e-310


GROUPS = {
    "short": [random.Random(1).randint(-(10**14), 10**14) / 10**9 for _ in range(500)],
    "long": [random.Random(2).uniform(-1e9, 1e9) for _ in range(500)],
    "both": [0.1, 1 / 3, -2.5, 1e-14 / 3, 7e9 + 1 / 3, 999999.999999999] * 20,
    "tiny": [1.2345e-15, 3e-16, -1e-310],
    "huge": [1e25, 0.25, 1 / 3], "nan": [float("nan"), 1.0], "one": [-0.7], "none": [None], "zero": [0.0, None], "great": [999999.999] * 300,
}


def test_sums_by_group_are_those_of_the_decimals(spark):
    rows = [(k, v, 1) for k, values in GROUPS.items() for v in values]
    random.Random(3).shuffle(rows)
    found = set()
    for parts in (1, 6):
        frame = spark.createDataFrame(rows, "k string, v double, _n int").repartition(parts)
        means = {r.k: (r.m, r.n) for r in exact_by(frame.drop("_n"), ["k"], F.col("v"), "m", F.count("*").alias("n")).collect()}
        sums = {r.k: r.s for r in exact_by(frame.drop("_n"), ["k"], F.col("v"), "s", mean=False).collect()}
        whole = {r.k: (r.m, r.s) for r in frame.groupBy("k").agg(exact_avg(F.col("v")).alias("m"), exact_sum(F.col("v")).alias("s")).collect()}
        for k, values in GROUPS.items():
            assert means[k][1] == len(values)
            known = [v for v in values if v is not None]
            if k == "nan":
                assert math.isnan(sums[k]) and math.isnan(means[k][0])
            elif not known:
                assert sums[k] is None and means[k][0] is None
            elif k in ("huge", "tiny"):
                assert (means[k][0], sums[k]) == pytest.approx(whole[k], rel=1e-15)
            else:
                total = sum(Fraction(repr(v)) for v in known)
                assert sums[k] == float(total) == whole[k][1] and means[k][0] == float(total) / len(known) == whole[k][0]
        found.add(tuple((k, repr(means[k]), repr(sums[k])) for k in sorted(GROUPS)))
    assert len(found) == 1


def test_running_total_keeps_small_and_strange_values(spark):
    rows = [(1, i, v) for i, v in enumerate([0.00004, 0.00004, None, math.inf])] + [(2, 0, None)]
    frame = spark.createDataFrame(rows, "k int, t int, v double").withColumn("t", F.timestamp_seconds("t"))
    found = running_total(frame, "k", "t", "v", "total").orderBy("k", "t").collect()
    assert [r.total for r in found] == [0.00004, 0.00008, 0.00008, math.inf, 0.0]


def test_exact_means_fall_back_for_values_out_of_range(spark):
    frame = spark.createDataFrame([(1e25,), (3e25,), (None,)], "v double")
    assert tuple(frame.agg(exact_avg(F.col("v")), exact_sum(F.col("v"))).first()) == (2e25, 4e25)
    within = frame.agg(exact_avg(F.col("v") / 1e10)).first()
    assert tuple(within) == (2e15,)
    empty = frame.filter("v < 0").agg(exact_avg(F.col("v")), exact_sum(F.col("v"))).first()
    assert tuple(empty) == (None, None)


def test_recency_weighted_mean_of_the_worked_example(spark):
    years = [(1, 2018, 8.346), (1, 2019, 9.469), (1, 2020, 9.599), (1, 2021, 10.433), (1, 2022, 12.014)]
    frame = spark.createDataFrame(years + [(1, 2023, 99.0), (2, 2020, 7.0)], "k int, y int, v double")
    means = {r.k: r.m for r in recency_weighted_mean(frame, ["k"], "y", "v", 2022, "m").collect()}
    assert round(means[1], 4) == 10.5255
    assert means[2] == 7.0


def test_recency_weighted_mean_keeps_values_out_of_range(spark):
    frame = spark.createDataFrame([(1, 2000, 1e12), (1, 2001, 4e12)], "k int, y int, v double")
    assert recency_weighted_mean(frame, ["k"], "y", "v", 2001, "m").first().m == pytest.approx(3e12)


def test_recency_weighted_mean_against_its_definition(spark):
    random.seed(3)
    rows = [(0, random.randint(1990, 2001), random.randint(1, 20_000) / 1000) for _ in range(2000)]
    rows += [(random.randint(1, 30), random.randint(1990, 2001), random.choice([None, 5.5, 9.25])) for _ in range(200)]
    frame = spark.createDataFrame(rows, "k int, y int, v double")
    found = {r.k: r.m for r in recency_weighted_mean(frame, ["k"], "y", "v", 2001, "m").collect()}
    for key, group in itertools.groupby(sorted(rows, key=lambda r: r[0]), key=lambda r: r[0]):
        group = list(group)
        span = 2001 - min(y for _, y, _ in group) + 1
        weights = [1 - (2001 - y) / span for _, y, _ in group]
        values = [w * v for w, (_, _, v) in zip(weights, group) if v is not None]
        expected = sum(values) / sum(weights) if values else None
        assert found[key] == (pytest.approx(expected) if values else None)


def test_running_total_over_many_spans(spark):
    random.seed(4)
    rows = [(0, t, random.randint(0, 40) / 4) for t in random.sample(range(5000), 1500)]
    rows += [(k, t, random.choice([0.25, None])) for k in (1, 2) for t in range(0, 3000, 700)]
    frame = spark.createDataFrame(rows, "k int, t int, v double").withColumn(
        "t", F.timestamp_seconds("t")
    )
    found = running_total(frame, "k", "t", "v", "total", span_seconds=60)
    totals, expected = Counter(), {}
    for k, t, v in sorted(rows):
        totals[k] += v or 0
        expected[k, t] = totals[k]
    assert {(r.k, r.s): r.total for r in found.select("*", F.unix_timestamp("t").alias("s")).collect()} == expected


def pairs_by_brute_force(rows, k=10):
    """The definition: join first and last day, rank all pairs per band."""
    groups = defaultdict(list)
    for who, km, band, day, s in rows:
        if band not in (None, "0-40") and who is not None and day is not None:
            groups[who, band].append((day, s))
    found = []
    for (who, band), runs in groups.items():
        first, last = min(d for d, _ in runs), max(d for d, _ in runs)
        for f in (s for d, s in runs if d == first and s):
            for l in (s for d, s in runs if d == last and s):
                found.append((who, band, f, l, (l - f) / f * 100))
    tops = defaultdict(set)
    for row in found:
        tops[row[1]].add(row[4])
    ranks = {b: {v: i + 1 for i, v in enumerate(sorted(vs, reverse=True)[:k])} for b, vs in tops.items()}
    return Counter(row + (ranks[row[1]][row[4]],) for row in found if row[4] in ranks[row[1]])


@pytest.mark.parametrize("seed, negative", [(5, False), (6, True), (7, False)])
def test_most_improved_against_all_pairs(spark, seed, negative):
    random.seed(seed)
    kinds = [(50.0, "40-65"), (80.0, "65-90"), (7000.0, "None"), (30.0, "0-40"), (0.0, None)]
    speeds = [None, 0.0] + [x / 4 for x in range(4, 60)] + ([-1.5, -2.0, -0.25] if negative else [])
    days = ["01.01.2001", "02.01.2000", "31.12.1999", None]

    def row(who):
        km, band = random.choice(kinds)
        return who, km, band, random.choice(days), random.choice(speeds)

    rows = [row(0) for _ in range(400)] + [row(random.choice([None, *range(1, 40)])) for _ in range(400)]
    rows += [(50, 50.0, "40-65", "01.01.2001", 0.5)] * 3 + [(50, 50.0, "40-65", "31.12.1999", 55.0)] * 4
    # A band with one athlete only: no floor from other athletes.
    rows += [(99, 150.0, "120-200", d, random.choice(speeds)) for d in days[:2] * 40]
    frame = spark.createDataFrame(
        rows,
        "athlete_id bigint, distance_km double, distance_group_km string, event_dates string, "
        "athlete_average_speed_kmph double",
    )
    assert Counter(map(tuple, most_improved(frame).select(
        "athlete_id", "distance_group_km", "avg_speed_first_marathon", "avg_speed_last_marathon",
        "improvement_percentage", "rank_by_improvement").collect())) == pairs_by_brute_force(rows)


RUN = (
    "athlete_id bigint, distance_km double, distance_group_km string, event_dates string, "
    "athlete_average_speed_kmph double"
)


def test_most_improved_with_strange_speeds(spark):
    inf, nan = math.inf, math.nan
    ends = [(1, inf, 7.0), (2, 5.0, inf), (3, 5.0, nan), (4, 2.0, 3.0), (5, nan, 3.0), (6, None, 3.0), (7, 2.0, None)]
    rows = [(a, 50.0, "40-65", day, s) for a, *both in ends for day, s in zip(["01", "02"], both)]
    found = most_improved(spark.createDataFrame(rows, RUN)).collect()
    ranks = {r.athlete_id: (r.rank_by_improvement, str(r.improvement_percentage)) for r in found}
    assert ranks == {1: (1, "nan"), 3: (1, "nan"), 5: (1, "nan"), 2: (2, "inf"), 4: (3, "50.0")}


def test_most_improved_with_one_rank_and_a_tiny_speed(spark):
    rows = [(a, 50.0, "40-65", d, s) for a, f, l in [(1, 1e-310, 9.0), (2, 2.0, 3.0)] for d, s in (("01", f), ("02", l))]
    found = most_improved(spark.createDataFrame(rows, RUN), k=1).collect()
    assert [r.athlete_id for r in found] == [1]


def telemetry_rows(spark, rows):
    import datetime

    start = datetime.datetime(2024, 1, 1)
    full = [
        (r, start + datetime.timedelta(seconds=t), 0.0, 0.0, a, 0.0, 0, 0.0) for r, t, a in rows
    ]
    return spark.createDataFrame(full, TELEMETRY)


def test_previous_second_pairs(spark):
    gaps = telemetry_rows(spark, [(1, 0, 1.0), (1, 1, 2.5), (1, 3, 9.0)])
    assert [r.altitude_gain for r in live.altitude_gains(gaps).collect()] == [1.5]
    copies = telemetry_rows(
        spark, [(1, 0, 1.0)] * 2 + [(1, 1, 2.5), (1, 1, 2.5), (1, 1, 4.0)] + [(2, 1, 7.0), (1, 2, None)]
    )
    gains = Counter(r.altitude_gain for r in live.altitude_gains(copies).collect())
    assert gains == {1.5: 4, 3.0: 2, 0.0: 3}
    windows = live.as_table(live.elevation_windows(copies), "value").collect()
    assert [(r.runner_id, r.value) for r in windows] == [(1, 12.0)]


def test_latest(spark):
    table = spark.createDataFrame(
        [(1, 10, 1.0), (1, 20, 2.0), (2, 20, 5.0)], "runner_id bigint, time int, value double"
    )
    assert tuple(live.latest(table).first()) == (1, 20, 2.0)
    assert live.latest(table.filter("false")).collect() == []
    assert {tuple(r) for r in live.latest_per_runner(table).collect()} == {(1, 20, 2.0), (2, 20, 5.0)}
