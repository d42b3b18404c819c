"""Every registered query: name -> function of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries import doubles, inputs
from queries.inputs import derive, pair_raw, single_raw, stories, table, task_pairs, task_texts
from specflow.functions import jsontext, prompts
from specflow.functions import text as T
from specflow.operators import (
    columns,
    ids,
    inference,
    joins,
    judging,
    parsing,
    replies,
    report,
    tasks,
)
from specflow.operators import stories as story_ops
from specflow.plans import dual, evaluation, single
from specflow.plans.flow import Flow, Step
from specflow.session import materialize, table_path
from specflow.sources import readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SCORES = [f"judge_score_{s}_{c}" for s in "ab" for c in (*columns.CRITERIA, "total")]


def query(func):
    QUERIES[func.__name__] = func
    return func


def longs(df: DataFrame, names) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Means and deviations add up in another order elsewhere: compare to six digits."""
    return df.withColumns(
        {f.name: F.round(f.name, digits) for f in df.schema.fields if f.dataType.typeName() == "double"}
    )


def cores(spark) -> int:
    """Calls are slow and a small table may be one partition: spread the prompts."""
    return spark.sparkContext.defaultParallelism


def with_config(df: DataFrame) -> DataFrame:
    return df.withColumn("Config", F.concat(F.lit("C"), F.left("config", F.lit(1))))


# --- stories ----------------------------------------------------------------


@query
def stories_clean(spark, sf):
    return columns.clean_text_rows(stories(spark, sf))


@query
def stories_sampled(spark, sf):
    return columns.clean_text_rows(stories(spark, sf), sample_size=50, order_by=["story_id"])


@query
def stories_valid(spark, sf):
    return story_ops.valid_stories(stories(spark, sf), "input")


@query
def stories_valid_case(spark, sf):
    return story_ops.valid_stories(stories(spark, sf), "input", case_sensitive=True)


@query
def stories_flagged(spark, sf):
    return story_ops.flag_stories(stories(spark, sf), "input").select("story_id", "story_valid")


@query
def stories_validation_stats(spark, sf):
    return story_ops.validation_stats(stories(spark, sf), "input")


@query
def stories_reject_sample(spark, sf):
    return story_ops.reject_sample(stories(spark, sf), "input", ["story_id"]).select("story_id", "input")


@query
def story_ids(spark, sf):
    valid = story_ops.valid_stories(stories(spark, sf), "input")
    return ids.dense_id(valid, ["story_id"], unique=True).select("story_id", "us_id")


@query
def ids_by_tied_key(spark, sf):
    # a few priorities hold all orders: the id may not depend on one task per key
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    numbered = ids.dense_id(orders, ["o_orderpriority"], "row_id")
    return numbered.groupBy("o_orderpriority").agg(
        F.min("row_id").alias("first_id"),
        F.max("row_id").alias("last_id"),
        F.count_distinct("row_id").alias("ids"),
    )


@query
def story_batches(spark, sf):
    valid = story_ops.valid_stories(stories(spark, sf), "input")
    numbered = ids.dense_id(valid, ["story_id"], unique=True)
    return numbered.select(
        "story_id", ids.batch_id("us_id", 8).alias("batch_id"), ids.split_id("us_id", 4).alias("split_id")
    )


@query
def story_batch_count(spark, sf):
    return ids.batch_count(story_ops.valid_stories(stories(spark, sf), "input"), 8)


@query
def document_squeezed(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", T.squeeze("text").alias("squeezed"))
    return documents.select("doc_id", F.md5("squeezed").alias("md5"), F.length("squeezed").cast("long").alias("n"))


@query
def structured_story(spark, sf):
    cells = derive(spark, sf, inputs.STRUCTURED, "part")
    return readers.structured_story(cells).drop("input")


@query
def structured_story_valid(spark, sf):
    cells = readers.structured_story(derive(spark, sf, inputs.STRUCTURED, "part"))
    return story_ops.valid_stories(cells, "description").select("part_id", "description")


@query
def structured_story_build(spark, sf):
    part = table(spark, sf, "part")
    built = readers.build_structured_story(
        part, {"project": "p_brand", "summary": "p_name", "description": "p_type"}
    )
    return built.select("p_partkey", "input")


@query
def stories_csv(spark, sf):
    path = writers.write_table(stories(spark, sf), table_path(spark, "stories-csv"), "csv")
    return readers.read_csv(spark, path, "story_id long, project string, input string")


@query
def documents_csv(spark, sf):
    # whole documents as cells: line breaks and quotes inside, files cut into small splits
    path = table_path(spark, "documents-csv")
    writers.write_table(table(spark, sf, "documents").select("doc_id", "lang", "text"), path, "csv")
    back = readers.read_csv(spark, path, "doc_id long, lang string, text string")
    return back.select("doc_id", "lang", F.md5("text").alias("md5"), F.length("text").cast("long").alias("n"))


@query
def documents_csv_inferred(spark, sf):
    path = table_path(spark, "documents-csv-inferred")
    writers.write_table(table(spark, sf, "documents").select("doc_id", "n_chars", "source", "text"), path, "csv")
    back = readers.load(spark, csv_path=path)
    kinds = ",".join(kind for _, kind in back.dtypes)
    return back.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_chars").alias("chars"), F.sum(F.length("text")).alias("length"), F.lit(kinds).alias("kinds")
    )


# --- prompts ----------------------------------------------------------------


@query
def prompts_rendered(spark, sf):
    return stories(spark, sf).select("story_id", prompts.task_prompt("input").alias("prompt"))


@query
def judge_prompts(spark, sf):
    pairs = task_pairs(spark, sf)
    return pairs.select(
        "us_id",
        prompts.stricter(prompts.judge_prompt("input", "tasks_generator_a"), 1).alias("single"),
        prompts.pair_prompt("input", "tasks_generator_a", "tasks_generator_b").alias("pair"),
    )


# --- tasks ------------------------------------------------------------------


@query
def tasks_split(spark, sf):
    split = tasks.split_tasks(task_texts(spark, sf), "tasks")
    return split.select(
        "us_id",
        F.size("task_list").cast("long").alias("n"),
        F.array_join("task_list", " | ").alias("pieces"),
    )


@query
def tasks_exploded_global(spark, sf):
    return tasks.explode_tasks(task_texts(spark, sf), order_by=["us_id"], unique_order=True)


@query
def tasks_exploded_grouped(spark, sf):
    return tasks.explode_tasks(task_texts(spark, sf), group_by="us_id", unique_group=True)


@query
def tasks_exploded_brand(spark, sf):
    return tasks.explode_tasks(task_texts(spark, sf), group_by="brand", order_by=["us_id"])


@query
def tasks_strict_numbers(spark, sf):
    exploded = tasks.explode_tasks(
        task_texts(spark, sf), group_by="us_id", unique_group=True, strict_numbers=True
    )
    return exploded.select("us_id", "task_id", "task")


@query
def task_fields(spark, sf):
    exploded = tasks.explode_tasks(task_texts(spark, sf), group_by="us_id", unique_group=True)
    return tasks.task_fields(exploded).drop("task", "input", "brand")


@query
def document_tasks(spark, sf):
    answers = derive(spark, sf, inputs.DOCUMENT_TASKS, "documents")
    exploded = tasks.explode_tasks(answers, group_by="us_id", unique_group=True)
    return exploded.select("us_id", "task_id", F.md5("task").alias("md5"))


@query
def document_tasks_by_language(spark, sf):
    # four languages hold all documents: numbers run over very large groups
    answers = derive(spark, sf, inputs.DOCUMENT_TASKS, "documents")
    exploded = tasks.explode_tasks(answers, group_by="lang", order_by=["us_id"])
    return exploded.select("lang", "us_id", "task_id", F.md5("task").alias("md5"))


@query
def dual_task_compare(spark, sf):
    return tasks.compare_tasks(task_pairs(spark, sf))


@query
def dual_task_join(spark, sf):
    pairs = task_pairs(spark, sf)
    sides = [
        tasks.explode_tasks(
            pairs.select("us_id", "input", f"tasks_generator_{s}"),
            f"tasks_generator_{s}",
            f"task_generator_{s}",
            group_by="us_id",
            unique_group=True,
        )
        for s in "ab"
    ]
    return joins.join_tasks(*sides)


@query
def task_counts(spark, sf):
    return report.task_counts(tasks.compare_tasks(task_pairs(spark, sf)))


# --- JSON -------------------------------------------------------------------


@query
def json_parse_status(spark, sf):
    parsed = parsing.parse_json(derive(spark, sf, inputs.PROPS_DAMAGED, "events"), "raw")
    return parsed.select(
        "event_id", "parse_status", F.col("fields")["k"].alias("k"), F.col("fields")["note"].alias("note")
    )


@query
def json_parse_metrics(spark, sf):
    parsed = parsing.parse_json(derive(spark, sf, inputs.PROPS_DAMAGED, "events"), "raw")
    return parsing.parse_metrics(parsed)


@query
def json_fuzzy_keys(spark, sf):
    parsed = parsing.parse_json(derive(spark, sf, inputs.PROPS_KEYS, "events"), "raw")
    named = parsing.normalize_keys(parsed, "fields", columns.CRITERIA)
    keys = F.array_join(F.array_sort(F.map_keys("fields")), ",")
    return named.select(
        "event_id",
        keys.alias("keys"),
        F.col("fields")["granularity"].alias("granularity"),
        F.col("fields")["format"].alias("format"),
    )


@query
def json_duplicate_keys(spark, sf):
    parsed = parsing.parse_json(derive(spark, sf, inputs.DUPLICATE_KEYS, "events").select("event_id", "raw"), "raw")
    named = parsing.normalize_keys(parsed, "fields", columns.CRITERIA)
    keys = F.array_join(F.array_sort(F.map_keys("fields")), ",")
    return named.select("event_id", keys.alias("keys"), F.col("fields")["format"].alias("format"), F.col("fields")["k"].alias("k"))


@query
def pair_duplicate_keys(spark, sf):
    raw = derive(spark, sf, inputs.PAIR_DUPLICATES, "orders").select("us_id", "raw")
    scored = judging.parse_pair_judgement(raw, "raw")
    return longs(scored.select("us_id", "judge_score_a_coherence", "judge_winner", "judge_reason"), ["judge_score_a_coherence"])


@query
def single_duplicate_keys(spark, sf):
    raw = derive(spark, sf, inputs.SINGLE_DUPLICATES, "orders").select("us_id", "raw")
    scored = judging.parse_judgement(raw, "raw", parse_status="parse_status")
    return scored.select("us_id", "validacion_coherencia", "validacion_total", "validacion_aprobado", "parse_status")


@query
def page_braces(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", jsontext.clean_json("html").alias("cut"))
    return pages.select(
        "page_id", F.md5("cut").alias("md5"), jsontext.is_truncated("cut").alias("truncated")
    )


# --- judges -----------------------------------------------------------------


def _single(spark, sf) -> DataFrame:
    return judging.parse_judgement(single_raw(spark, sf), "raw")


def _pairs(spark, sf) -> DataFrame:
    return judging.parse_pair_judgement(pair_raw(spark, sf), "raw")


@query
def single_judge_scores(spark, sf):
    scored = _single(spark, sf).drop("raw", "config")
    return scored.withColumns(
        {c: F.array_join(c, "|") for c in ("validacion_problemas", "validacion_recomendaciones")}
    )


@query
def single_judge_by_threshold(spark, sf):
    scored = judging.parse_judgement(single_raw(spark, sf), "raw", threshold=30.0, policy="threshold")
    return scored.select("us_id", "validacion_total", "validacion_aprobado")


@query
def approval_report(spark, sf):
    return rounded(report.approval_report(_single(spark, sf), ["config"]))


@query
def single_zero_scores(spark, sf):
    scored = _single(spark, sf)
    zero = judging.has_zero(scored, judging.single_score_columns())
    return scored.select("us_id", zero.alias("zero"))


@query
def pair_judge_scores(spark, sf):
    return longs(_pairs(spark, sf).drop("raw", "config"), SCORES)


@query
def selected_outputs(spark, sf):
    scored = _pairs(spark, sf)
    picked = columns.chosen("judge_winner", F.lit("first"), F.lit("second"))
    return scored.select("us_id", picked.alias("selected_output"))


@query
def totals_recomputed(spark, sf):
    wrong = _pairs(spark, sf).withColumns(
        {
            "judge_score_a_total": F.lit(0),
            "judge_score_b_total": F.lit(0),
            "judge_score_a_format": F.nullif("judge_score_a_format", F.lit(9)),
        }
    )
    fixed = columns.recompute_totals(wrong)
    return longs(
        fixed.select("us_id", "judge_score_a_total", "judge_score_b_total"),
        ["judge_score_a_total", "judge_score_b_total"],
    )


@query
def numbers_coerced(spark, sf):
    texts = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN ' 7.5 ' WHEN 2 THEN 'n/a' ELSE '0x1p3' END AS score",
    )
    return columns.coerce_numbers(texts, ["score"])


# --- inference with the md5 doubles -----------------------------------------


@query
def generated_rows(spark, sf):
    turns = table(spark, sf, "conversations")
    replies = inference.generate(
        turns, "text", doubles.WRITER, details=True, partitions=cores(spark)
    )
    return replies.select(
        "conv_id", "turn", "generation", F.col("generation_attempts").cast("long").alias("attempts")
    )


@query
def generated_twice(spark, sf):
    asks = [
        inference.Ask("text", "generation_a", doubles.WRITER, "seconds_a"),
        inference.Ask("text", "generation_b", doubles.SHORT_WRITER, "seconds_b"),
    ]
    replies = inference.generate_all(table(spark, sf, "conversations"), asks, cores(spark))
    timed = columns.add_total_time(replies, ["seconds_a", "seconds_b"])
    return timed.select(
        "conv_id", "turn", "generation_a", "generation_b", (F.col("total_time") >= 0).alias("timed")
    )


@query
def generated_cached(spark, sf):
    # prompts repeat a lot: five priorities over all orders, one call each
    store = table_path(spark, "replies-by-priority")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    prompt = F.concat(F.lit("Explain "), F.col("o_orderpriority"))
    first = inference.generate_cached(orders, prompt, doubles.WRITER, store)
    again = inference.generate_cached(first, prompt, doubles.WRITER, store, "reused")
    return again.select(
        "o_orderkey", F.md5("generation").alias("md5"), (F.col("generation") == F.col("reused")).alias("same")
    )


@query
def generated_partly_cached(spark, sf):
    # a third of the orders share one prompt, the others have their own; some replies are known
    store = table_path(spark, "replies-partly-known")
    orders = table(spark, sf, "orders").select("o_orderkey")
    number = F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_orderkey"))
    prompt = F.concat(F.lit("Order "), number.cast("string"))
    inference.generate_cached(orders.filter("o_orderkey % 5 = 0"), prompt, doubles.WRITER, store)
    reply = inference.generate_cached(orders, prompt, doubles.WRITER, store)
    asked = replies.stored(spark, store).agg(F.count(F.lit(1)).alias("asked"))
    return reply.select("o_orderkey", F.md5("generation").alias("md5")).crossJoin(F.broadcast(asked))  # one row


@query
def generated_forgotten(spark, sf):
    # two models share a store; the replies of one are forgotten, then asked again, and the store is made compact
    store = table_path(spark, "replies-forgotten")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    prompt = F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"))
    inference.generate_cached(orders, prompt, doubles.WRITER, store)
    inference.generate_cached(orders, prompt, doubles.SHORT_WRITER, store)
    replies.forget(spark, store, doubles.WRITER.identity())
    left = materialize(replies.stored(spark, store).agg(F.count(F.lit(1)).alias("left")), "replies-left")
    inference.generate_cached(orders.filter("o_orderkey % 2 = 0"), prompt, doubles.WRITER, store)
    # written, since cleaning the store deletes what was read
    reply = materialize(inference.generate_cached(orders, prompt, doubles.WRITER, store), "replies-asked-again")
    replies.compact(spark, store)
    replies.clean(spark, store)
    again = inference.generate_cached(reply, prompt, doubles.WRITER, store, "reused")
    other = inference.generate_cached(again, prompt, doubles.SHORT_WRITER, store, "other")
    kept = replies.stored(spark, store, doubles.WRITER.identity()).agg(F.count(F.lit(1)).alias("kept"))
    shown = other.select(
        "o_orderkey", F.md5("generation").alias("md5"), (F.col("generation") == F.col("reused")).alias("same"), F.md5("other").alias("other_md5")
    )
    return shown.crossJoin(F.broadcast(left)).crossJoin(F.broadcast(kept))  # one row each


@query
def generated_refreshed(spark, sf):
    # replies known from an earlier run are all asked again; the store then holds the new ones alone
    store = table_path(spark, "replies-refreshed")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    inference.generate_cached(turns, F.concat(F.lit("first: "), "text"), doubles.WRITER, store)
    reply = inference.generate_cached(turns, "text", doubles.WRITER, store, refresh=True)
    held = replies.stored(spark, store).agg(F.count(F.lit(1)).alias("held"))
    return reply.select("conv_id", "turn", F.md5("generation").alias("md5")).crossJoin(F.broadcast(held))  # one row


@query
def requests_shown(spark, sf):
    # what the model was sent: system text, format, sampling, through every way a call can end
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    shown = inference.generate(turns, "text", doubles.SHOWER, details=True)
    return shown.select(
        "conv_id", "turn", "generation", "generation_error", F.col("generation_attempts").cast("long").alias("attempts")
    )


@query
def pair_call_failures(spark, sf):
    pairs = task_pairs(spark, sf)
    pairs = pairs.withColumn("tasks_generator_b", F.when(F.col("us_id") % 11 != 0, F.col("tasks_generator_b")))
    scored = judging.judge_pairs(
        pairs, "input", "tasks_generator_a", "tasks_generator_b", doubles.FAILING_PAIR_JUDGE, prompt=F.concat(F.lit("p "), F.col("us_id").cast("string")), zero_retries=0
    )
    return longs(
        scored.select("us_id", "judge_score_a_coherence", "judge_score_b_total", "judge_winner", "judge_reason", "judge_status"),
        ["judge_score_a_coherence", "judge_score_b_total"],
    )


@query
def single_call_failures(spark, sf):
    prompt = F.concat(F.lit("p "), F.col("us_id").cast("string"))
    scored = judging.judge(task_texts(spark, sf), "input", "tasks", doubles.FAILING_JUDGE, prompt=prompt, zero_retries=0)
    return scored.select(
        "us_id",
        "validacion_coherencia",
        "validacion_total",
        "validacion_aprobado",
        F.array_join("validacion_problemas", "|").alias("problems"),
        F.array_join("validacion_recomendaciones", "|").alias("advice"),
        "judge_status",
    )


@query
def generations_joined(spark, sf):
    turns = table(spark, sf, "conversations")
    a = inference.generate(turns, "text", doubles.WRITER, "generation_a").drop("text")
    b = inference.generate(turns, "text", doubles.SHORT_WRITER, "generation_b")
    return joins.join_generations(a, b, ["conv_id", "turn"], ["generation_b"])


@query
def zero_reask(spark, sf):
    prompt = F.concat(F.lit("Judge: "), F.col("input"), F.lit(" / "), F.col("tasks"))
    scored = judging.judge(
        task_texts(spark, sf),
        "input",
        "tasks",
        doubles.SINGLE_JUDGE,
        prompt=prompt,
        partitions=cores(spark),
    )
    return scored.select("us_id", "validacion_total", "validacion_aprobado", "judge_status")


@query
def pair_reask(spark, sf):
    prompt = F.concat("input", F.lit(" / "), F.col("tasks_generator_a"), F.lit(" / "), F.col("tasks_generator_b"))
    scored = judging.judge_pairs(
        task_pairs(spark, sf),
        "input",
        "tasks_generator_a",
        "tasks_generator_b",
        doubles.PAIR_JUDGE,
        prompt=prompt,
        partitions=cores(spark),
    )
    return longs(
        scored.select(
            "us_id",
            "judge_score_a_total",
            "judge_score_b_total",
            "judge_winner",
            "judge_reason",
            "judge_status",
            F.md5("selected_output").alias("selected_md5"),
        ),
        ["judge_score_a_total", "judge_score_b_total"],
    )


# --- reports ----------------------------------------------------------------


@query
def pair_evaluation(spark, sf):
    raw = with_config(pair_raw(spark, sf))
    long = evaluation.evaluate_answers(raw, "raw")
    return rounded(long)


@query
def generator_metrics(spark, sf):
    return rounded(report.generator_metrics(_pairs(spark, sf)))


@query
def generator_metrics_judged_only(spark, sf):
    # all calls of one configuration failed: -1 / -5, left out here
    answered = F.when(F.col("config") != "5-LOW", F.col("raw"))
    raw = pair_raw(spark, sf).withColumn("raw", answered)
    scored = judging.parse_pair_judgement(raw, "raw")
    return rounded(report.generator_metrics(scored, ["config"], exclude_failed=True))


@query
def criterion_means(spark, sf):
    return rounded(report.criterion_means(_pairs(spark, sf)))


@query
def wins(spark, sf):
    return rounded(report.wins(_pairs(spark, sf), ["config"]))


@query
def run_timings(spark, sf):
    timings = derive(spark, sf, inputs.TIMINGS, "orders")
    total = columns.add_total_time(timings, ["generation_time_a", "generation_time_b", "judge_time"])
    return rounded(report.run_timings(total, ["config"]))


def _result_files(spark, sf) -> str:
    """One result per priority, as a run of the two-generator job would leave them."""
    folder = table_path(spark, "result-files")
    scored = materialize(_pairs(spark, sf).drop("raw"), "scored")
    for priority in scored.select(F.col("config").alias("p")).distinct().collect():
        kept = scored.filter(F.col("config") == priority.p).drop("config")
        if priority.p.startswith("2"):
            kept = kept.drop("judge_score_b_format")
        if priority.p.startswith("3"):
            kept = kept.select(*reversed(kept.columns))
        if priority.p.startswith("4"):
            kept = kept.drop("judge_score_b_total", "judge_winner")
        name = f"run_dual_test{priority.p[0]}_judge_results.csv"
        writers.write_table(kept, f"{folder}/{name}", "csv")
    return folder


@query
def consolidated_criteria(spark, sf):
    return rounded(evaluation.evaluate_files(spark, _result_files(spark, sf)).criteria)


@query
def consolidated_metrics(spark, sf):
    return rounded(evaluation.evaluate_files(spark, _result_files(spark, sf)).metrics)


@query
def consolidated_totals(spark, sf):
    results = readers.read_judge_results(spark, _result_files(spark, sf), multi_line=False)
    return rounded(report.consolidate(results, by=["test"]).select("test", "Config", "Gen", "Criteria_Total"))


@query
def boxplot_from_files(spark, sf):
    boxes = evaluation.evaluate_files(spark, _result_files(spark, sf)).boxes
    return longs(boxes, ["rows", "outliers"])


@query
def summary_files(spark, sf):
    folder = table_path(spark, "summaries")
    evaluation.evaluate_files(spark, _result_files(spark, sf)).write(folder)
    back = spark.read.option("header", True).csv(f"{folder}/aggregate_summary.csv")
    return back.select("Config", "Gen", *[F.col(c).cast("double").alias(c) for c in ("Mean", "Pass", "Win")])


@query
def criteria_pivot(spark, sf):
    long = evaluation.evaluate_answers(with_config(pair_raw(spark, sf)), "raw")
    pivoted = report.pivot_generators(report.criterion_summary(long), [c.capitalize() for c in columns.CRITERIA])
    return rounded(pivoted)


@query
def score_boxplot(spark, sf):
    boxes = report.box_stats(with_config(_pairs(spark, sf)), ["Config"])
    return longs(joins.with_model_names(boxes, readers.experiments(spark)), ["rows", "outliers"])


@query
def score_outliers(spark, sf):
    # the answers of every configuration are much alike; calls that failed stand far out
    scored = judging.parse_pair_judgement(derive(spark, sf, inputs.PAIR_STEADY, "orders"), "raw")
    return longs(report.outliers(with_config(scored), ["Config"]), ["value", "n"])


@query
def fractional_boxplot(spark, sf):
    # nearly every total is a value of its own
    return longs(report.box_stats(derive(spark, sf, inputs.FRACTIONAL_TOTALS, "lineitem"), ["Config"]), ["rows", "outliers"])


@query
def fractional_outliers(spark, sf):
    return longs(report.outliers(derive(spark, sf, inputs.FRACTIONAL_TOTALS, "lineitem"), ["Config"]), ["n"])


# --- whole jobs -------------------------------------------------------------


@query
def flow_chain(spark, sf):
    flow = (
        Flow("customers")
        >> Step("load", lambda: table(spark, sf, "customer"))
        >> Step(
            "balance",
            lambda df: columns.add_column(df, "cents", lambda b: F.round(b * 100), ["c_acctbal"]),
        )
        >> Step(
            "shout",
            lambda df: columns.add_column(df, "loud", lambda s: s.str.upper() + "!", ["segment"], "string", vectorized=True),
            inputs=["segment"],
            rename_in={"c_mktsegment": "segment"},
            rename_out={"loud": "shout"},
        )
        >> Step("model", lambda df: columns.add_constant(df, "model", "m1"))
        >> Step("keep", lambda df: columns.keep_columns(df, ["cents", "shout", "model", "c_custkey"]))
        >> Step("first", lambda df: columns.move_first(df, "c_custkey"))
    )
    return flow.run()


@query
def written_tables(spark, sf):
    """Tasks and valid stories written as CSV and read again, side by side as line counts and digests."""
    folder = table_path(spark, "written")
    exploded = tasks.explode_tasks(task_texts(spark, sf), group_by="us_id", order_by=["us_id"], unique_order=True)
    kept = writers.write_tasks(exploded.select("us_id", "task_id", "task"), writers.run_path(folder, "tasks", timestamp="t"), "csv")
    valid = writers.write_valid(stories(spark, sf), "input", folder, "valid.csv")
    first = readers.load(spark, csv_path=kept).select(F.col("us_id").cast("long").alias("id"), "task")
    second = readers.load_stories(spark, valid).select(F.col("story_id").cast("long").alias("id"), F.col("input").alias("task"))
    both = first.withColumn("kind", F.lit("task")).unionByName(second.withColumn("kind", F.lit("story")))
    return both.select("kind", "id", F.md5("task").alias("md5"))


@query
def run_stamps(spark, sf):
    start, end = datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 5, 5)
    stamped = columns.add_run_times(table(spark, sf, "orders").select("o_orderkey"), start, end)
    seconds = F.unix_timestamp("end_timestamp") - F.unix_timestamp("start_timestamp")
    return stamped.select("o_orderkey", seconds.alias("seconds"), F.date_format("start_timestamp", "HH:mm:ss").alias("begun"))


@query
def single_run(spark, sf):
    result = single.run_single(
        stories(spark, sf), doubles.WRITER, ["story_id"], judge_call=doubles.SINGLE_JUDGE
    )
    return result.select(
        "us_id",
        "story_id",
        "task_id",
        "task",
        "generator_model_name",
        "judge_model_name",
        "validacion_total",
        "validacion_aprobado",
        "judge_status",
    )


@query
def single_run_report(spark, sf):
    run = single.run_single(stories(spark, sf), doubles.WRITER, ["story_id"], judge_call=doubles.SINGLE_JUDGE)
    counts, approval, parsed = single.report_single(materialize(run, "single-run"))
    return rounded(counts.crossJoin(approval).crossJoin(parsed.select("success", "repaired", "failed")))  # one row each


@query
def single_run_file(spark, sf):
    run = single.run_single(
        stories(spark, sf), doubles.WRITER, ["story_id"], prompt=F.concat(F.lit("Split: "), "input"), case_sensitive=True
    )
    path = single.write_single(run, table_path(spark, "single-file"), "t")
    back = readers.read_csv(spark, path)
    return back.select(F.col("us_id").cast("long"), F.col("task_id").cast("long"), F.md5("task").alias("md5"))


def _dual(spark, sf):
    result = dual.run_dual(
        stories(spark, sf), doubles.WRITER, doubles.SHORT_WRITER, doubles.PAIR_JUDGE, ["story_id"], zero_retries=0,
        judge_prompt=F.concat("input", F.lit(" / "), F.col("tasks_generator_a")),
    )
    return result


@query
def dual_run_report(spark, sf):
    counts, wins_, criteria, timings = _dual(spark, sf).report()
    seconds = timings.select((F.col("mean_total_time") >= F.col("mean_judge_time")).alias("timed"))
    return rounded(criteria.crossJoin(counts).crossJoin(wins_.select("wins_a", "wins_b", "mean_a", "mean_b")).crossJoin(seconds))


@query
def dual_run_files(spark, sf):
    _, judged = _dual(spark, sf).write(table_path(spark, "dual-files"), "t")
    back = readers.read_judge_results(spark, judged.rsplit("/", 1)[0])
    return back.select(
        F.col("us_id").cast("long").alias("us_id"),
        "judge_score_a_total",
        "judge_winner",
        F.size("missing_columns").cast("long").alias("missing"),
        "test",
    )


@query
def settings_refused(spark, sf):
    """Every row plans a run: which of its settings are out of range."""
    runs = derive(spark, sf, inputs.PLANNED_RUNS, "orders")
    problems = columns.setting_problems({name: name for name in columns.SETTING_RANGES})
    return runs.select("run_id", F.array_join(problems, ",").alias("refused"), F.size(problems).cast("long").alias("n"))


@query
def settings_kept(spark, sf):
    # the rows that may run, through a step that would refuse any other by name
    runs = derive(spark, sf, inputs.PLANNED_RUNS, "orders")
    named = {name: name for name in columns.SETTING_RANGES}
    flow = (
        Flow("runs")
        >> Step("fit", lambda df: df.filter(F.size(columns.setting_problems(named)) == 0), inputs=list(named))
        >> Step("check", lambda df: columns.refuse_settings(df, named), inputs=list(named))
    )
    return flow.run(runs).select("run_id", "workers")


@query
def flow_outputs(spark, sf):
    # an intermediate result by name
    flow = (
        Flow("orders")
        >> Step("load", lambda: table(spark, sf, "orders"))
        >> Step("priced", lambda df: columns.add_column(df, "cents", lambda p: F.round(p * 100).cast("long"), ["o_totalprice"]))
        >> Step("none", lambda df: df.filter("false"))
    )
    flow.run()
    return flow.outputs["priced"].select("o_orderkey", "cents")


@query
def dual_run_tasks(spark, sf):
    return dual.run_dual(
        stories(spark, sf), doubles.WRITER, doubles.SHORT_WRITER, doubles.PAIR_JUDGE, ["story_id"]
    ).tasks


@query
def dual_run_scores(spark, sf):
    judged = dual.run_dual(
        stories(spark, sf), doubles.WRITER, doubles.SHORT_WRITER, doubles.PAIR_JUDGE, ["story_id"]
    ).judge_results()
    return longs(
        judged.select(
            "us_id", "input", "judge_score_a_total", "judge_score_b_total", "judge_winner",
            "judge_score_a_coherence", "judge_score_b_granularity", "judge_reason",
            (F.col("end_timestamp") >= F.col("start_timestamp")).alias("stamped"),
            (F.col("total_time") >= F.col("judge_time")).alias("timed"),
        ),
        ["judge_score_a_total", "judge_score_b_total", "judge_score_a_coherence", "judge_score_b_granularity"],
    )
