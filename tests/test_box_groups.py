"""Box plots of totals with many distinct values."""

import statistics
from functools import reduce

import pytest
from pyspark.sql import functions as F

from specflow.operators import report


def plans(boxes):
    return boxes._jdf.queryExecution().optimizedPlan().toString()


def frame(spark, rows):
    return spark.createDataFrame(rows, "Config string, judge_score_a_total double, judge_score_b_total double")


def test_fractional_totals_are_not_gathered(spark):
    a = [k / 128 for k in range(1, 3001)]
    df = frame(spark, [(c, v, None) for c in ("C1", None) for v in a]).repartition(5)
    counted = report.ranked(report.score_counts(df, ["Config"]), ["Config", "Gen"])
    quartiles = report.quantiles(counted, ["Config", "Gen"], {"q1": 0.25, "median": 0.5, "q3": 0.75})
    for word in ("percentile", "collect_list"):
        assert word not in plans(quartiles)
    # the windows left add up a group's parts, a row each
    assert plans(quartiles).count("Window [") == plans(quartiles).count("Window [sum(__sum")
    want = statistics.quantiles(a, n=4, method="inclusive")
    boxes = report.box_stats(df, ["Config"])
    assert "Window" not in plans(boxes)
    assert {r.Config: [r.q1, r.median, r.q3] for r in boxes.collect()} == {"C1": want, None: want}


def test_quantiles_against_plain_ones(spark):
    groups = {
        "one": [7.5],
        "two": [1.0, 2.0],
        "same": [3.0] * 40,
        "mixed": [x * x % 101 / 4 for x in range(333)],
        "far": [*map(float, range(30)), 500.0, 500.0, -90.5],
        "negative": [-5.0, -5.0, 0.25, 50.0, 49.75],
    }
    df = frame(spark, [(g, v, -v) for g, vs in groups.items() for v in vs]).repartition(3)
    boxes = {(r.Config, r.Gen): r for r in report.box_stats(df, ["Config"]).collect()}
    assert len(boxes) == 2 * len(groups)
    for (g, gen), r in boxes.items():
        values = [v if gen == "G1" else -v for v in groups[g]]
        want = statistics.quantiles(values, n=4, method="inclusive") if len(values) > 1 else values * 3
        assert [r.q1, r.median, r.q3] == want and r.rows == len(values)
        low, high = want[0] - 1.5 * (want[2] - want[0]), want[2] + 1.5 * (want[2] - want[0])
        inside = [v for v in values if low <= v <= high]
        assert r.whisker_low == min([want[0], *inside]) and r.whisker_high == max([want[2], *inside])
        assert r.outliers == len(values) - len(inside)
    far = report.outliers(df, ["Config"]).collect()
    assert sum(r.n for r in far) == sum(r.outliers for r in boxes.values()) > 0


def test_nothing_to_plot(spark):
    df = frame(spark, [("C1", None, None)])
    assert report.box_stats(df, ["Config"]).collect() == [] and report.outliers(df).collect() == []
    whole = report.box_stats(frame(spark, [("C1", 1.0, 2.0), ("C2", 3.0, None)])).collect()
    assert sorted((r.Gen, r.median, r.rows) for r in whole) == [("G1", 2.0, 2), ("G2", 2.0, 1)]


def test_judged_rows_are_read_once(spark, tmp_path):
    path = f"{tmp_path}/judged"
    frame(spark, [("C1", float(k), float(-k)) for k in range(500)]).write.parquet(path)
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(path)
    counted = df.mapInArrow(count, df.schema)
    report.box_stats(counted, ["Config"]).collect()
    assert read.value == 500
    assert reduce(max, [r.rows for r in report.box_stats(df, ["Config"]).collect()]) == 500


def test_only_totals_near_a_quartile_are_sorted(spark, monkeypatch):
    # 200,000 different totals, a third of the rows equal, and a group of which no two are near each other
    a = spark.range(200_000).selectExpr("'C1' AS Config", "double((id * 7919) % 200000) / 64 AS judge_score_a_total", "CASE WHEN id % 3 = 0 THEN 7.5 ELSE double(id) / 8 END AS judge_score_b_total")
    wide = spark.range(400).selectExpr("CAST(NULL AS STRING) AS Config", "power(10, id - 200) AS judge_score_a_total", "-power(2, id) AS judge_score_b_total")
    df = a.unionByName(wide).repartition(6)
    kept, real = {}, report.materialize

    def seen(table, label, path=None):
        kept[label] = real(table, label, path)
        return kept[label]

    monkeypatch.setattr(report, "materialize", seen)
    boxes = {(r.Config, r.Gen): [r.q1, r.median, r.q3, r.rows] for r in report.box_stats(df, ["Config"]).collect()}
    plain = df.groupBy("Config").agg(*[F.percentile(f"judge_score_{s}_total", [0.25, 0.5, 0.75]).alias(s) for s in "ab"]).collect()
    want = {(r.Config, gen): [*r[side], 200_000 if r.Config else 400] for r in plain for gen, side in (("G1", "a"), ("G2", "b"))}
    assert boxes.keys() == want.keys()
    for k in want:
        assert boxes[k] == pytest.approx(want[k], rel=1e-12)
    assert "score-counts" not in kept and kept["near-quantiles"].count() < 2000


def test_whole_and_odd_totals(spark):
    nan = float("nan")
    rows = [("C1", 1, nan), ("C1", 2, 2.0), ("C1", 3, nan), ("C1", 4, float("inf")), ("C2", None, -0.0), ("C2", 5, 0.0)]
    df = spark.createDataFrame(rows, "Config string, judge_score_a_total int, judge_score_b_total double")
    got = {(r.Config, r.Gen): (r.rows, r.q1, r.median, r.q3) for r in report.box_stats(df, ["Config"]).collect()}
    assert got["C1", "G1"] == (4, 1.75, 2.5, 3.25) and got["C2", "G1"] == (1, 5.0, 5.0, 5.0)
    assert got["C2", "G2"] == (2, 0.0, 0.0, 0.0) and got["C1", "G2"][0] == 4
