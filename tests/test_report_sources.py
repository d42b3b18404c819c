import statistics
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from specflow.operators import joins, report
from specflow.operators.columns import CRITERIA
from specflow.plans import evaluation
from specflow.sources import readers, writers

# config, A total, B total, winner
ROWS = [
    ("C1", 40, 30, "A"),
    ("C1", 35, 36, "B"),
    ("C1", -5, -5, "A"),
    ("C1", 34, None, None),
    ("C2", 50, 10, "A"),
]


@pytest.fixture
def judged(spark):
    df = spark.createDataFrame(
        ROWS, "Config string, judge_score_a_total int, judge_score_b_total int, judge_winner string"
    )
    scores = {f"judge_score_{s}_{c}": F.lit(i + (s == "b")) for s in "ab" for i, c in enumerate(CRITERIA)}
    return df.withColumns(scores)


def test_metrics(judged):
    rows = {(r.Config, r.Gen): r for r in report.generator_metrics(judged, ["Config"]).collect()}
    a, b = rows["C1", "G1"], rows["C1", "G2"]
    assert a.Mean == pytest.approx(26.0)
    assert a.Std == pytest.approx(statistics.stdev([40, 35, -5, 34]))
    # a null counts as not passed and as no win, but not in the mean
    assert (a.Pass, b.Pass, a.Win, b.Win) == (50.0, 25.0, 50.0, 25.0)
    assert b.Mean == pytest.approx(61 / 3)
    # one row has no deviation
    assert rows["C2", "G1"].Std is None


def test_metrics_without_failures(judged):
    rows = {r.Gen: r for r in report.generator_metrics(judged.filter("Config = 'C1'"), exclude_failed=True).collect()}
    assert rows["G1"].Mean == pytest.approx(109 / 3)
    assert rows["G1"].Pass == pytest.approx(200 / 3)


def test_metrics_of_nothing(judged):
    rows = report.generator_metrics(judged.limit(0)).collect()
    assert [(r.Gen, r.Mean) for r in rows] == [("G1", None), ("G2", None)]


def test_criterion_means_and_pivot(judged):
    means = report.criterion_means(judged, ["Config"])
    rows = {(r.Config, r.Gen): r for r in means.collect()}
    assert (rows["C1", "G1"].Granularity, rows["C1", "G2"].Granularity) == (4.0, 5.0)
    pivoted = report.pivot_generators(means, ["Format"])
    assert pivoted.columns == ["Config", "G1_Format", "G2_Format"]
    assert {tuple(r) for r in pivoted.collect()} == {("C1", 3.0, 4.0), ("C2", 3.0, 4.0)}


def test_wins_approval_counts_timings(spark, judged):
    row = report.wins(judged).first()
    assert (row.stories, row.wins_a, row.wins_b, row.wins_a_pct) == (5, 3, 1, 60.0)
    approvals = spark.createDataFrame([(True, 40.0), (False, 20.0)], "validacion_aprobado boolean, validacion_total double")
    assert tuple(report.approval_report(approvals).first()) == (1, 2, 50.0, 30.0)
    tasks = spark.createDataFrame([(1,), (1,), (2,)], "us_id int")
    assert tuple(report.task_counts(tasks).first()) == (3, 2)
    times = spark.createDataFrame([(1.0, 2.0, 3.0, 6.0), (3.0, None, 3.0, None)], "generation_time_a double, generation_time_b double, judge_time double, total_time double")
    assert tuple(report.run_timings(times).first()) == (2.0, 2.0, 3.0, 6.0)


def test_box_stats(spark):
    a = [1, 2, 3, 4, 5, 6, 7, 8, 9, 50]
    df = spark.createDataFrame(
        [("C1", v, 5) for v in a], "Config string, judge_score_a_total int, judge_score_b_total int"
    )
    boxes = report.box_stats(df, ["Config"])
    rows = {r.Gen: r for r in boxes.collect()}
    quartiles = statistics.quantiles(a, n=4, method="inclusive")
    assert [rows["G1"].q1, rows["G1"].median, rows["G1"].q3] == quartiles
    assert (rows["G1"].whisker_low, rows["G1"].whisker_high, rows["G1"].outliers) == (1.0, 9.0, 1)
    assert (rows["G2"].whisker_low, rows["G2"].whisker_high, rows["G2"].outliers) == (5.0, 5.0, 0)
    far = report.outliers(df, ["Config"]).collect()
    assert [(r.Gen, r.value, r.n) for r in far] == [("G1", 50, 1)]
    named = joins.with_model_names(boxes, readers.experiments(spark)).collect()
    assert {(r.Gen, r.Model) for r in named} == {("G1", "Llama 3.1"), ("G2", "Mistral")}
    assert joins.with_model_names(boxes.withColumn("Config", F.lit("C9")), readers.experiments(spark)).count() == 0


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([("C2", "G1", 0.125), ("C1", "G2", 0.375)], "Config string, Gen string, Mean double")
    assert [(r.Config, r.Mean) for r in report.sort_and_round(df).collect()] == [("C1", 0.38), ("C2", 0.12)]


def test_csv_cells_survive(spark, tmp_path):
    rows = [(1, '{"project": "P", "summary": "say ""hi"""}'), (2, "line one\nline, two"), (3, " padded "), (4, None)]
    df = spark.createDataFrame(rows, "id int, input string")
    path = writers.write_table(df, f"{tmp_path}/t", "csv")
    assert sorted(map(tuple, readers.read_csv(spark, path, "id int, input string").collect())) == rows
    inferred = readers.load(spark, csv_path=path)
    assert dict(inferred.dtypes) == {"id": "int", "input": "string"}
    assert readers.load(spark, df) is df
    with pytest.raises(ValueError):
        readers.load(spark)


def test_load_stories(spark, tmp_path):
    (tmp_path / "s.csv").write_text('input,id\n" a ",1\n,2\n"{""k"": ""v""}",3\n')
    loaded = readers.load_stories(spark, f"{tmp_path}/s.csv")
    assert sorted((r.id, r.input) for r in loaded.collect()) == [(1, "a"), (3, '{"k": "v"}')]
    (tmp_path / "e.csv").write_text('input\n" "\n')
    with pytest.raises(ValueError, match="no usable"):
        readers.load_stories(spark, f"{tmp_path}/e.csv")
    with pytest.raises(ValueError, match="missing"):
        readers.load_stories(spark, f"{tmp_path}/s.csv", column="story")


def test_structured_story(spark):
    text = '{"project": "P", "summary": "S", "description": "As a user, I want x so that y"}'
    df = readers.structured_story(spark.createDataFrame([(text,), ("no",)], "input string"))
    assert [(r.project, r.description) for r in df.collect()] == [("P", "As a user, I want x so that y"), (None, None)]
    built = readers.build_structured_story(
        spark.createDataFrame([("P", 'q"', None)], "a string, b string, c string"),
        {"project": "a", "summary": "b", "description": "c"},
    )
    assert built.first().input == '{"project":"P","summary":"q\\"","description":null}'


def test_nested_columns_become_json_in_csv(spark, tmp_path):
    df = spark.sql("SELECT array('a', 'b') AS list")
    path = writers.write_table(df, f"{tmp_path}/n", "csv")
    assert readers.read_csv(spark, path, "list string").first().list == '["a","b"]'
    with pytest.raises(ValueError):
        writers.write_table(df, f"{tmp_path}/x", "xlsx")


def test_config_ids(spark):
    names = ["run_dual_test4_output_judge_results", "a_b_test10_judge_results", "plain", "a_b"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    ids = [tuple(r) for r in df.select(readers.config_id("n"), readers.config_id("n", numbered=True)).collect()]
    assert ids == [("C4", "C4"), ("C0", "C10"), ("plain", "plain"), (None, None)]


def test_run_path():
    assert writers.run_path("out/", "tasks", timestamp="T") == "out/tasks_T.csv"
    stamp = writers.run_path("out", "tasks").removeprefix("out/tasks_").removesuffix(".csv")
    assert datetime.strptime(stamp, "%Y%m%d_%H%M%S")


def test_write_valid(spark, tmp_path):
    df = spark.createDataFrame([("As a user, I want x so that y", 1), ("no", 2)], "story string, id int")
    path = writers.write_valid(df, "story", str(tmp_path), "clean.csv")
    assert path == f"{tmp_path}/clean.csv"
    assert [r.id for r in readers.read_csv(spark, path).collect()] == [1]
    assert "validated_stories_" in writers.write_valid(df, "story", str(tmp_path))
    assert writers.write_valid(df.filter("id = 2"), "story", f"{tmp_path}/none") is None
    assert not (tmp_path / "none").exists()


def result_rows(spark, value):
    types = {c: "double" if "time" in c else "int" for c in readers.JUDGE_RESULT_COLUMNS}
    known = {"us_id": 1, "input": "a,\n\"b\"", "judge_winner": "A", "judge_reason": "line\nbreak"}
    return spark.range(3).select(
        *[
            F.lit(known.get(c, value)).cast("string" if c in known and c != "us_id" else types[c]).alias(c)
            for c in readers.JUDGE_RESULT_COLUMNS
        ]
    )


def test_result_files_of_all_shapes(spark, tmp_path):
    writers.write_judge_results(result_rows(spark, 8), str(tmp_path), "run_dual_test1", "csv")
    reordered = result_rows(spark, 6).select(*reversed(readers.JUDGE_RESULT_COLUMNS)).drop("judge_score_a_format")
    writers.write_table(reordered, f"{tmp_path}/run_dual_test2_judge_results.csv", "csv")
    # a single file as another tool writes it, with an unusable score
    header = ",".join(readers.JUDGE_RESULT_COLUMNS)
    lines = [header] + [",".join("n/a" if c.endswith("a_total") else "B" if c == "judge_winner" else "4" for c in readers.JUDGE_RESULT_COLUMNS)]
    (tmp_path / "run_dual_test3_judge_results.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "notes.csv").write_text("x\n1\n")

    results = readers.read_judge_results(spark, str(tmp_path))
    assert {r.Config: r["count"] for r in results.groupBy("Config").count().collect()} == {"C1": 3, "C2": 3, "C3": 1}
    assert results.filter("Config = 'C1'").first().judge_reason == "line\nbreak"

    summaries = evaluation.evaluate_files(spark, str(tmp_path))
    criteria = {(r.Config, r.Gen): r for r in summaries.criteria.collect()}
    assert criteria["C1", "G1"].Format == 8.0
    assert criteria["C2", "G1"].Format is None and criteria["C2", "G2"].Format == 6.0
    metrics = {(r.Config, r.Gen): r for r in summaries.metrics.collect()}
    assert (metrics["C1", "G1"].Win, metrics["C3", "G2"].Win) == (100.0, 100.0)
    assert (metrics["C3", "G1"].Mean, metrics["C3", "G1"].Pass) == (None, 0.0)

    summaries.write(f"{tmp_path}/out")
    written = readers.read_csv(spark, f"{tmp_path}/out/aggregate_summary.csv")
    assert written.columns == ["Config", "Gen", "Mean", "Std", "Pass", "Win"]
    assert [(r.Config, r.Gen) for r in written.collect()] == [(c, g) for c in ("C1", "C2", "C3") for g in ("G1", "G2")]


def test_results_are_read_once_for_both_summaries(spark, tmp_path, monkeypatch):
    writers.write_judge_results(result_rows(spark, 8), str(tmp_path), "run_dual_test1", "csv")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def counted(*args, **kwargs):
        results = readers.read_judge_results(*args, **kwargs)
        return results.mapInArrow(count, results.schema)

    monkeypatch.setattr(evaluation, "read_judge_results", counted)
    evaluation.evaluate_files(spark, str(tmp_path)).write(f"{tmp_path}/out")
    assert read.value == 3
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/criterion_summary.csv").count() == 2


def test_results_as_parquet(spark, tmp_path):
    writers.write_judge_results(result_rows(spark, 8), str(tmp_path), "run_dual_test1")
    results = readers.read_judge_results(spark, str(tmp_path), fmt="parquet")
    assert {(r.Config, r.judge_score_b_total) for r in results.collect()} == {("C1", 8)}
    with pytest.raises(ValueError, match="no "):
        readers.read_judge_results(spark, f"{tmp_path}/none")


def test_many_files_take_one_scan_per_header(spark, tmp_path):
    for k in range(40):
        header = "us_id,judge_score_a_total" if k % 2 else "judge_score_a_total,us_id,judge_winner"
        (tmp_path / f"x_y_test{k}_judge_results.csv").write_text(header + "\n" + ("7,9\n" if k % 2 else "9,7,B\n"))
    results = readers.read_judge_results(spark, str(tmp_path), multi_line=False, numbered=True)
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    rows = results.select("test", "Config", "us_id", "judge_score_a_total", "judge_winner").collect()
    assert {tuple(r) for r in rows} == {
        (f"x_y_test{k}_judge_results", f"C{k}", "7", "9", None if k % 2 else "B") for k in range(40)
    }


def test_text_totals_are_numbers_in_boxes(spark):
    totals = ["9", "9", "10", "10", "11", "12", "30"]
    df = spark.createDataFrame([(t, t) for t in totals], "judge_score_a_total string, judge_score_b_total string")
    box = report.box_stats(df).where("Gen = 'G1'").first()
    assert (box.whisker_low, box.whisker_high, box.outliers) == (9.0, 12.0, 1)


def test_scratch_deletes_its_tables(spark):
    from specflow.session import materialize, paths_like, scratch

    with scratch(spark) as folder:
        kept = materialize(spark.range(3), "numbers")
        assert kept.count() == 3 and paths_like(spark, folder)
    assert not paths_like(spark, folder)
