"""Every registered query against its SQL."""

import pytest
from oracle import connect, differences

import __spark_entry__
from catalogue import ORACLE as SQL
from catalogue import QUERIES as NAMES

SF = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in __spark_entry__.queries().items() if name in NAMES}


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, tables, name):
    expected_names, names, missing, extra = differences(tables, QUERIES[name](spark, SF), SQL[name])
    assert names == expected_names
    assert not missing and not extra


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 70


EXPECTED_ROWS = {
    "q1_fastest_events": 18, "q2_athletes_per_band": 7, "q3_speed_by_band_and_age": 21,
    "q4_most_attended_events": 550, "q5_fastest_countries": 70, "q6_athletes_per_country": 25,
    "q7_athletes_per_age_group": 3, "q8_distance_per_decade": 2, "q9_most_improved": 70,
    "q10_speed_by_gender": 14,
}


@pytest.mark.parametrize("name", EXPECTED_ROWS)
def test_row_counts(spark, name):
    assert QUERIES[name](spark, SF).count() == EXPECTED_ROWS[name]


def test_questions_come_in_order(spark):
    bands = [r.distance_group_km for r in QUERIES["q10_speed_by_gender"](spark, SF).collect()]
    order = ["40-65", "65-90", "90-120", "120-200", "200-1000", "1000-6000", "None"]
    assert bands == [b for b in order for _ in range(2)]
