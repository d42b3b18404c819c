import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from specflow.operators import columns, stories

GOOD = "As a user, I want to login so that I can see my account"

CASES = [
    (GOOD, True, True),
    ("as a user, I want to login so that I see it", True, False),
    ("AS AN ADMIN, I WANT X SO THAT Y", True, False),
    ("As an engineer, I want x so that y", True, True),
    ("As a user,   I want x\n\tso  that y  ", True, True),
    ("As a user, I want x so that y", True, True),
    ("As a user, I want x, I want y so that z so that w", True, True),
    ("  As a user, I want x so that y", True, True),
    ("As a user I want x so that y", False, False),
    ("As a , I want x so that y", False, False),
    ("As a user, I want so that y", False, False),
    ("As a user, I want x so that", False, False),
    ("As a user, I want x", False, False),
    ("Note: As a user, I want x so that y", False, False),
    ("As any user, I want x so that y", False, False),
    ("I want x", False, False),
    ("", False, False),
    (None, False, False),
]


def test_format_table(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "id int, story string")
    for case_sensitive in (False, True):
        got = {
            r.id
            for r in stories.valid_stories(df, "story", case_sensitive).select("id").collect()
        }
        want = {i for i, c in enumerate(CASES) if c[2 if case_sensitive else 1]}
        assert got == want


def test_keeps_text_and_other_columns(spark):
    text = "As a user,\n  I want x so that y "
    df = spark.createDataFrame([(text, 1, "high"), ("no", 2, "low")], "story string, id int, p string")
    assert [tuple(r) for r in stories.valid_stories(df, "story").collect()] == [(text, 1, "high")]


def test_values_that_are_not_text_fail(spark):
    df = spark.createDataFrame([(12345,), (None,)], "story int")
    assert stories.valid_stories(df, "story").count() == 0


def test_stats_and_rejects(spark):
    df = spark.createDataFrame(
        [(1, GOOD), (2, "b"), (3, "a"), (4, None), (5, "z"), (6, GOOD)], "id int, story string"
    )
    stats = stories.validation_stats(df, "story").first()
    assert (stats.total, stats.valid, stats.invalid) == (6, 2, 4)
    assert stats.valid_pct == pytest.approx(100 / 3)
    assert [r.id for r in stories.reject_sample(df, "story", ["id"]).collect()] == [2, 3, 4]


def test_stats_of_nothing(spark):
    stats = stories.validation_stats(spark.createDataFrame([], "story string"), "story").first()
    assert (stats.total, stats.valid_pct) == (0, None)


def test_flag_keeps_all_rows(spark):
    df = spark.createDataFrame([(GOOD,), (None,)], "story string")
    assert {r.story_valid for r in stories.flag_stories(df, "story").collect()} == {True, False}


def test_missing_column_fails_before_any_job(spark):
    with pytest.raises(ValueError, match="nope"):
        stories.valid_stories(spark.range(1), "nope")


def test_clean_text_rows(spark):
    df = spark.createDataFrame(
        [(1, " a "), (2, None), (3, " \n"), (4, "b\x1c")], "id int, input string"
    )
    seen = Observation()
    rows = columns.clean_text_rows(df, observation=seen).collect()
    assert sorted((r.id, r.input) for r in rows) == [(1, "a"), (4, "b")]
    assert seen.get == {"rows": 4, "dropped": 2}


def test_sample_is_taken_before_cleaning(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "id int, input string")
    assert [r.id for r in columns.clean_text_rows(df, sample_size=2, order_by=["id"]).collect()] == [2]
    with pytest.raises(ValueError):
        columns.clean_text_rows(df, sample_size=0, order_by=["id"])
    with pytest.raises(ValueError):
        columns.clean_text_rows(df, sample_size=2)


def test_column_operators(spark):
    df = spark.createDataFrame([(1, 3), (2, 4)], "a int, b int")
    added = columns.add_column(df, "c", lambda a, b: a + b, ["a", "b"])
    kept = columns.keep_columns(added, ["c", "a"])
    assert [tuple(r) for r in kept.collect()] == [(4, 1), (6, 2)]
    python = columns.add_column(df, "c", lambda a, b: f"{a}-{b}", ["a", "b"], "string")
    assert [r.c for r in python.collect()] == ["1-3", "2-4"]
    constant = columns.add_column(df, "m", lambda: "x", returns="string")
    assert {r.m for r in constant.collect()} == {"x"}
    assert columns.move_first(df, "b").columns == ["b", "a"]
    with pytest.raises(ValueError):
        columns.add_column(df, "d", lambda v: v, ["nonexistent"])


def test_drop_missing_counts(spark):
    df = spark.createDataFrame([("a", None), ("b", "c"), (None, None)], "x string, y string")
    seen = Observation()
    assert columns.drop_missing(df, ["x", "y"], seen).count() == 1
    assert seen.get == {"rows": 3, "dropped": 2}


def test_totals_ignore_nulls(spark):
    names = [f"judge_score_{s}_{c}" for s in "ab" for c in columns.CRITERIA]
    df = spark.range(1).select(
        *[F.lit(None if n.endswith("format") else 2).cast("int").alias(n) for n in names],
        F.lit(99).alias("judge_score_a_total"),
    )
    row = columns.recompute_totals(df).first()
    assert (row.judge_score_a_total, row.judge_score_b_total) == (8, 8)


def test_total_time_is_null_if_one_is(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None)], "x double, y double")
    assert [r.total_time for r in columns.add_total_time(df, ["x", "y"]).collect()] == [3.0, None]


@pytest.mark.parametrize(
    "bad",
    [
        {"batch_size": 0},
        {"temperature": 2.1},
        {"temperature": -0.1},
        {"max_tokens": 0},
        {"workers": 0},
        {"threshold": 50.5},
    ],
)
def test_settings_out_of_range(bad):
    with pytest.raises(ValueError):
        columns.check_settings(**bad)


def test_settings_in_range():
    columns.check_settings(batch_size=1, temperature=2.0, max_tokens=1, workers=1, threshold=0.0)
