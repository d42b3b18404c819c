"""Chaining, and what the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from queries import doubles, inputs
from specflow.functions import prompts
from specflow.operators import columns, joins, judging, parsing, report, stories, tasks
from specflow.plans import dual, single
from specflow.plans.flow import Flow, Step
from specflow.sources import readers

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flow_runs_in_order(spark):
    flow = Flow("f")
    flow.add(Step("load", lambda: spark.createDataFrame([(1, 3), (2, 4)], "a int, b int")))
    flow >> Step("sum", lambda df: columns.add_column(df, "c", lambda a, b: a + b, ["a", "b"]), inputs=["a", "b"])
    flow >> Step("keep", lambda df: df.select("a", "x"), rename_in={"c": "x"}, rename_out={"x": "y"})
    result = flow.run()
    assert result.columns == ["a", "y"]
    assert [r.y for r in result.collect()] == [4, 6]
    assert flow.outputs["sum"].columns == ["a", "b", "c"]
    again = flow.steps[1:]
    assert len(again) == 2


def test_flow_on_a_given_table(spark):
    def double(df):
        return df.withColumn("id", F.col("id") * 2)

    flow = Flow("f") >> double
    assert [r.id for r in flow.run(spark.range(3)).collect()] == [0, 2, 4]
    assert list(flow.outputs) == ["double"]


def test_flow_errors_name_the_step(spark):
    flow = Flow("f") >> Step("wrong", lambda df: df, inputs=["nonexistent"])
    with pytest.raises(ValueError, match="nonexistent") as caught:
        flow.run(spark.range(1))
    assert "step 'wrong' of flow 'f'" in caught.value.__notes__[0]
    with pytest.raises(ValueError):
        Flow("empty").run()


def test_render_in_one_pass(spark):
    df = spark.createDataFrame([("{{b}}", "x", None)], "a string, b string, c string")
    template = "{{a}}|{{ b }}|{{c}}|{{unknown}}|{{\n}}"
    row = df.select(prompts.render(template, {"a": "a", "b": "b", "c": "c"})).first()
    assert row[0] == "{{b}}|x||{{unknown}}|{{\n}}"


def test_prompts_hold_their_parts(spark):
    df = spark.createDataFrame([(" story ", "t1", "t2")], "s string, a string, b string")
    row = df.select(
        prompts.task_prompt("s").alias("t"),
        prompts.judge_prompt("s", "a", 30.0).alias("j"),
        prompts.pair_prompt("s", "a", "b").alias("p"),
        prompts.stricter("s", 0).alias("n"),
        prompts.stricter("s", 2).alias("r"),
    ).first()
    assert row.t.endswith("\nstory") and "{{" not in row.t
    assert "below 30.0 of 50" in row.j and "t1" in row.j
    assert "t1" in row.p and "t2" in row.p and "{{" not in row.p
    assert row.n == " story " and "RETRY 2" in row.r


@pytest.fixture(scope="module")
def native(spark):
    stories_df = inputs.stories(spark, SF)
    single_raw = inputs.single_raw(spark, SF)
    pair_raw = inputs.pair_raw(spark, SF)
    pairs = inputs.task_pairs(spark, SF)
    return {
        "valid": stories.valid_stories(stories_df, "input"),
        "clean": columns.clean_text_rows(stories_df),
        "exploded": tasks.explode_tasks(inputs.task_texts(spark, SF), group_by="us_id", unique_group=True),
        "compared": tasks.compare_tasks(pairs),
        "parsed": parsing.parse_json(single_raw, "raw"),
        "single": judging.parse_judgement(single_raw, "raw"),
        "pair": judging.parse_pair_judgement(pair_raw, "raw"),
    }


def test_row_operators_stay_in_the_jvm_without_shuffle(native):
    for name, df in native.items():
        text = plan(df)
        for word in ("Exchange", "Python", "Arrow", "Window", "BatchEval"):
            assert word not in text, (name, word)


def test_task_operators_are_one_codegen_stage(native):
    text = plan(native["exploded"])
    steps = [line for line in text.splitlines() if "Project" in line or "Generate" in line]
    assert steps and all("*(1)" in line for line in steps)


def test_scans_read_only_what_is_needed(spark):
    orders = judging.parse_pair_judgement(inputs.pair_raw(spark, SF), "raw").select("us_id", "judge_winner")
    schema = plan(orders).split("ReadSchema:")[1]
    assert "o_totalprice" not in schema and "o_orderdate" not in schema
    late = stories.valid_stories(inputs.stories(spark, SF), "input").filter(F.col("project") == "BUILDING")
    assert "EqualTo(c_mktsegment,BUILDING)" in plan(late)


def test_reports_aggregate_before_the_shuffle(spark):
    scored = judging.parse_pair_judgement(inputs.pair_raw(spark, SF), "raw")
    text = plan(report.consolidate(scored.withColumnRenamed("config", "Config"), "Config"))
    assert text.count("Exchange") == 1
    assert "partial_avg" in text
    assert "Window" not in text


def test_small_dimension_is_sent_to_the_tasks(spark):
    scored = judging.parse_pair_judgement(inputs.pair_raw(spark, SF), "raw")
    boxes = report.box_stats(scored.withColumnRenamed("config", "Config"), ["Config"])
    assert plan(boxes).count("FileScan") == 1
    assert "BroadcastHashJoin" in plan(joins.with_model_names(boxes, readers.experiments(spark)))


def test_native_operators_accept_a_stream(spark, tmp_path):
    source = f"{tmp_path}/in"
    inputs.single_raw(spark, SF).write.parquet(source)
    stream = spark.readStream.schema("us_id long, config string, raw string").parquet(source)
    scored = judging.parse_judgement(stream, "raw").filter("judge_status = 'ok'")
    query = (
        scored.writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    batch = judging.parse_judgement(spark.read.parquet(source), "raw").filter("judge_status = 'ok'")
    assert spark.read.parquet(f"{tmp_path}/out").count() == batch.count() > 0


def test_single_run_end_to_end(spark):
    source = inputs.stories(spark, SF)
    result = single.run_single(source, doubles.WRITER, ["story_id"], judge_call=doubles.SINGLE_JUDGE)
    rows = result.collect()
    valid = stories.valid_stories(source, "input").count()
    assert len(rows) == 2 * valid
    assert result.columns[0] == "us_id"
    assert sorted(r.task_id for r in rows) == list(range(1, 2 * valid + 1))
    assert all(0 <= r.validacion_total <= 50 for r in rows)
    with pytest.raises(ValueError):
        single.run_single(source, doubles.WRITER, ["story_id"], threshold=51)


def test_dual_run_end_to_end(spark):
    source = inputs.stories(spark, SF)
    result = dual.run_dual(source, doubles.WRITER, doubles.SHORT_WRITER, doubles.PAIR_JUDGE, ["story_id"], sample_size=40)
    judged = result.judge_results()
    assert judged.columns == list(readers.JUDGE_RESULT_COLUMNS)
    rows = judged.collect()
    assert sorted(r.us_id for r in rows) == list(range(1, len(rows) + 1))
    assert all(r.total_time >= 0 and r.start_timestamp <= r.end_timestamp for r in rows)
    assert result.tasks.columns == ["us_id", "task_id", "input", "task_generator_a", "task_generator_b"]
    assert result.tasks.count() == 2 * len(rows)


def test_a_run_is_reported_from_one_reading(spark):
    columns_ = {f"judge_score_{s}_{c}": F.col("id").cast("int") for s in "ab" for c in (*columns.CRITERIA, "total")}
    judged = spark.range(5).withColumns(columns_).selectExpr(
        "*", "id AS us_id", "'story' AS input", "if(id = 4, null, 'summary: a\\nsummary: b') AS tasks_generator_a", "'summary: c' AS tasks_generator_b",
        "if(id % 2 = 0, 'A', 'B') AS judge_winner", "1.0D AS generation_time_a", "2.0D AS generation_time_b", "3.0D AS judge_time", "6.0D AS total_time",
    )
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counted = judged.mapInArrow(count, judged.schema)
    found = dual.DualResult(tasks.compare_tasks(judged), counted).report()
    rows = [t.collect() for t in found]
    assert read.value == 5
    one = dual.DualResult(tasks.compare_tasks(judged), judged)
    assert rows[0] == report.task_counts(one.tasks).collect()
    assert rows[1] == report.wins(judged).collect()
    assert sorted(rows[2]) == sorted(report.criterion_means(judged).collect())
    assert rows[3] == report.run_timings(judged).collect()
    assert [t.columns for t in found] == [
        report.task_counts(one.tasks).columns, report.wins(judged).columns, report.criterion_means(judged).columns, report.run_timings(judged).columns,
    ]


def test_settings_of_rows(spark):
    rows = [(1, 0.0, 5, 1, 0.0), (0, 2.1, 0, 0, 50.1), (None, None, None, None, None), (3, float("nan"), 1, 9, 50.0)]
    df = spark.createDataFrame(rows, "batch_size int, temperature double, max_tokens int, workers int, threshold double")
    named = {name: name for name in columns.SETTING_RANGES}
    problems = [r[0] for r in df.select(columns.setting_problems(named)).collect()]
    assert problems == [[], list(columns.SETTING_RANGES), [], ["temperature"]]
    for row, found in zip(rows, problems):  # the same as the check of a single run
        given = dict(zip(columns.SETTING_RANGES, row))
        for name, value in given.items():
            if name in found:
                with pytest.raises(ValueError, match=name):
                    columns.check_settings(**{name: value})
            else:
                columns.check_settings(**{name: value})
    assert "Python" not in plan(df.select(columns.setting_problems(named)))
    assert columns.refuse_settings(df.where("batch_size = 1"), named).count() == 1
    with pytest.raises(Exception, match="out of range: temperature"):
        columns.refuse_settings(df.where("batch_size = 3"), named).collect()
    with pytest.raises(ValueError, match="no such settings"):
        columns.setting_problems({"colour": "batch_size"})
