"""Shapes of physical plans that matter at scale."""

import pytest

import __spark_entry__
from paceline import fixtures
from paceline.plans import live, questions

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "question", [questions.fastest_events, questions.most_attended_events, questions.fastest_countries]
)
def test_ranks_are_limited_before_the_shuffle(spark, question):
    text = plan(question(fixtures.distance_results(spark, SF)))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_questions_read_only_their_columns_and_push_filters(spark):
    text = plan(questions.athletes_per_band(fixtures.distance_results(spark, SF)))
    assert "GreaterThanOrEqual(distance_km,40.0)" in text
    scan = text[text.index("ReadSchema"):].split("\n")[0]
    assert "distance_km" in scan and "athlete_country" not in scan


def test_history_needs_one_shuffle(spark):
    from paceline.plans.history import weighted_history

    text = plan(weighted_history(fixtures.distance_results(spark, SF), 21, 2001))
    assert text.count("Exchange hashpartitioning") == 1 and "Window" not in text


def test_compare_drops_other_seconds_before_the_shuffle(spark):
    text = plan(live.comparisons(live.speeds(fixtures.telemetry(spark, SF))))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Filter" in text


BATCH = [name for name in __spark_entry__.queries() if not name.startswith(("stream_", "sink_", "source_", "topic_"))]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(__spark_entry__.queries()[name](spark, SF))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert operator not in text
