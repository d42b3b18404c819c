import os
import time

import pytest
from pyspark.sql import functions as F

from specflow.operators import inference, judging, replies
from specflow.operators.inference import Ask, ModelCall


def echo():
    def chat(model, messages, options, format):
        return f"{model}:{messages[-1]['content']}"

    return chat


def counting(folder):
    """Writes one file per call, so that calls in worker processes can be counted."""

    def client():
        def chat(model, messages, options, format):
            with open(f"{folder}/{time.time_ns()}-{os.getpid()}-{id(messages)}", "w"):
                pass
            return "reply to " + messages[-1]["content"]

        return chat

    return client


def failing(times, folder):
    """Fails the first ``times`` calls for each prompt."""

    def client():
        def chat(model, messages, options, format):
            name = f"{folder}/{messages[-1]['content']}"
            tries = len(open(name).read()) if os.path.exists(name) else 0
            with open(name, "a") as f:
                f.write("x")
            if tries < times:
                raise ConnectionError("down")
            return f"after {tries}"

        return chat

    return client


def fixed(text):
    def client():
        return lambda model, messages, options, format: text

    return client


def seen_request():
    def chat(model, messages, options, format):
        roles = ",".join(m["role"] for m in messages)
        return f"{roles}|{options['temperature']}|{format}"

    return chat


@pytest.fixture
def prompts(spark):
    rows = [("Hello", 1), ("World", None), ("Test", 3), ("Data", 2**60 + 1), (None, 5)]
    return spark.createDataFrame(rows, "prompt string, n long")


@pytest.mark.parametrize("workers", [1, 4])
def test_each_row_gets_its_own_reply(prompts, workers):
    call = ModelCall(echo, "m", workers=workers)
    rows = inference.generate(prompts, "prompt", call, "reply", time_column="sec").collect()
    got = {r.prompt: (r.n, r.reply) for r in rows}
    # other columns pass untouched, large numbers and nulls included
    assert got == {
        "Hello": (1, "m:Hello"),
        "World": (None, "m:World"),
        "Test": (3, "m:Test"),
        "Data": (2**60 + 1, "m:Data"),
        None: (5, None),
    }
    assert all(r.sec >= 0 for r in rows if r.prompt)


def test_prompt_may_be_a_column(prompts):
    reply = inference.generate(prompts, F.upper("prompt"), ModelCall(echo, "m")).select("generation")
    assert "m:HELLO" in {r.generation for r in reply.collect()}


def test_called_once_per_row_whatever_follows(spark, tmp_path):
    df = spark.range(20).select(F.col("id").cast("string").alias("prompt"))
    replies = inference.generate(df, "prompt", ModelCall(counting(str(tmp_path)), "m"))
    replies.count()
    joined = replies.alias("a").join(replies.alias("b"), "prompt")
    assert joined.filter(F.col("a.generation") == F.col("b.generation")).count() == 20
    assert len(list(tmp_path.iterdir())) == 20


def test_retry_until_it_works(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",)], "prompt string")
    call = ModelCall(failing(2, str(tmp_path)), "m", backoff=0.0, max_retries=3)
    rows = inference.generate(df, "prompt", call, details=True).collect()
    assert {(r.generation, r.generation_attempts, r.generation_error) for r in rows} == {("after 2", 3, None)}


def test_row_that_keeps_failing_is_null(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "prompt string")
    call = ModelCall(failing(9, str(tmp_path)), "m", backoff=0.0, max_retries=1)
    row = inference.generate(df, "prompt", call, details=True).first()
    assert (row.generation, row.generation_attempts, row.generation_error) == (None, 2, "down")


def test_backoff_doubles(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "prompt string")
    call = ModelCall(failing(2, str(tmp_path)), "m", backoff=0.1)
    row = inference.generate(df, "prompt", call, time_column="sec").first()
    assert row.sec >= 0.3


def test_request_parts(spark):
    df = spark.createDataFrame([("a",)], "prompt string")
    call = ModelCall(seen_request, "m", system="be brief", options={"temperature": 0.7}, response_format="json")
    assert inference.generate(df, "prompt", call).first().generation == "system,user|0.7|json"
    plain = ModelCall(seen_request, "m")
    assert inference.generate(df, "prompt", plain).first().generation == "user|0.3|None"


def test_two_generators_in_one_pass(prompts):
    rows = inference.generate_all(
        prompts,
        [Ask("prompt", "a", ModelCall(echo, "m1"), "ta"), Ask("prompt", "b", ModelCall(echo, "m2", workers=2))],
        partitions=3,
    )
    assert rows.columns == ["prompt", "n", "a", "ta", "b"]
    got = {r.prompt: (r.a, r.b) for r in rows.collect()}
    assert got["Test"] == ("m1:Test", "m2:Test")


def test_empty_input(spark):
    df = spark.createDataFrame([], "prompt string")
    assert inference.generate(df, "prompt", ModelCall(echo, "m")).columns == ["prompt", "generation"]
    assert inference.generate(df, "prompt", ModelCall(echo, "m")).count() == 0


def test_replies_are_reused(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    store = str(tmp_path / "store")
    call = ModelCall(counting(str(calls)), "m")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "prompt string, n int")
    first = inference.generate_cached(df, "prompt", call, store)
    assert {(r.n, r.generation) for r in first.collect()} == {
        (1, "reply to a"),
        (2, "reply to a"),
        (3, "reply to b"),
        (4, None),
    }
    assert len(list(calls.iterdir())) == 2
    more = df.unionByName(spark.createDataFrame([("c", 5)], "prompt string, n int"))
    inference.generate_cached(more, "prompt", call, store).collect()
    assert len(list(calls.iterdir())) == 3
    # another setting is another key
    warmer = ModelCall(counting(str(calls)), "m", options={"temperature": 0.9})
    inference.generate_cached(df, "prompt", warmer, store).collect()
    assert len(list(calls.iterdir())) == 5


def test_refresh_forgets_the_store(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    call = ModelCall(counting(str(calls)), "m")
    df = spark.createDataFrame([("a",), ("b",)], "prompt string")
    store = str(tmp_path / "store")
    inference.generate_cached(df, "prompt", call, store).collect()
    again = inference.generate_cached(df.limit(1), "prompt", call, store, refresh=True)
    assert again.count() == 1
    assert len(list(calls.iterdir())) == 3
    assert replies.stored(spark, store).count() == 1


def test_failures_are_not_kept(spark, tmp_path):
    tries = tmp_path / "tries"
    tries.mkdir()
    call = ModelCall(failing(1, str(tries)), "m", backoff=0.0, max_retries=0)
    df = spark.createDataFrame([("a",)], "prompt string")
    store = str(tmp_path / "store")
    assert inference.generate_cached(df, "prompt", call, store).first().generation is None
    assert inference.generate_cached(df, "prompt", call, store).first().generation == "after 1"


def test_settings_are_checked():
    with pytest.raises(ValueError):
        ModelCall(echo, "m", workers=0)
    with pytest.raises(ValueError):
        ModelCall(echo, "m", options={"temperature": 3})


def test_judge_drops_rows_it_cannot_judge(spark):
    df = spark.createDataFrame([("s", "t"), ("s", None), (None, "t")], "story string, tasks string")
    answer = (
        '{"coherence": {"puntuacion": 8}, "completeness": {"puntuacion": 7}, "feasibility": {"puntuacion": 9},'
        ' "format": {"puntuacion": 8}, "granularity": {"puntuacion": 7}}'
    )
    judged = judging.judge(df, "story", "tasks", ModelCall(fixed(answer), "j"))
    assert [(r.validacion_total, r.validacion_aprobado, r.judge_status) for r in judged.collect()] == [(39.0, True, "ok")]


def test_judge_call_failure_row(spark, tmp_path):
    df = spark.createDataFrame([("s", "t")], "story string, tasks string")
    call = ModelCall(failing(9, str(tmp_path)), "j", backoff=0.0, max_retries=0)
    row = judging.judge(df, "story", "tasks", call, prompt=F.lit("p")).first()
    assert (row.validacion_total, row.validacion_formato, row.judge_status) == (-5.0, -1.0, "call_failed")
    assert row.validacion_problemas == ["Error de conexión con modelo"]


def test_zero_scores_are_asked_again_and_the_last_answer_stays(spark, tmp_path):
    zero = '{"coherence": {"puntuacion": 0}, "completeness": {"puntuacion": 7}, "feasibility": {"puntuacion": 9}, "format": {"puntuacion": 8}, "granularity": {"puntuacion": 7}}'

    def client():
        def chat(model, messages, options, format):
            with open(f"{tmp_path}/{time.time_ns()}", "w") as f:
                f.write(messages[-1]["content"])
            return zero

        return chat

    df = spark.createDataFrame([("s", "t")], "story string, tasks string")
    row = judging.judge(df, "story", "tasks", ModelCall(client, "j")).first()
    assert (row.validacion_total, row.judge_status) == (31.0, "ok")
    texts = [p.read_text() for p in sorted(tmp_path.iterdir())]
    assert ["RETRY" in t for t in texts] == [False, True, True]
    assert "RETRY 2" in texts[2] and "RETRY 1" not in texts[2]


def test_pair_judge_statuses(spark, tmp_path):
    df = spark.createDataFrame([("in", "A", "B"), ("in", None, "B")], "input string, a string, b string")
    answer = '{"coherence_a": 7, "coherence_b": 8, "winner": "B", "reason": "r"}'
    rows = judging.judge_pairs(df, "input", "a", "b", ModelCall(fixed(answer), "j"), zero_retries=0).collect()
    got = {r.a: (r.judge_score_a_total, r.judge_winner, r.selected_output, r.judge_status) for r in rows}
    assert got == {"A": (7, "B", "B", "ok"), None: (-5, "A", None, "missing_input")}
    call = ModelCall(failing(1, str(tmp_path)), "j", backoff=0.0)
    failed = judging.judge_pairs(df.limit(1), "input", "a", "b", call, prompt=F.lit("p"), zero_retries=0).first()
    assert (failed.judge_score_b_total, failed.judge_status) == (-5, "call_failed")
    assert failed.judge_reason == "Judge evaluation failed: down"
    assert failed.selected_output == "A"


def slow_first():
    import time

    def chat(model, messages, options, format):
        if messages[-1]["content"] == "p0":
            time.sleep(1.5)
        else:
            time.sleep(0.01)
        return messages[-1]["content"]

    return chat


def test_a_slow_call_holds_up_no_others(spark):
    # 60 rows in batches of 10: with a barrier per batch the slow call would idle the pool
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(60).selectExpr("id AS n", "concat('p', id) AS prompt").coalesce(1)
        rows = inference.generate(df, "prompt", ModelCall(slow_first, "m", workers=2), time_column="s", partitions=1).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r.n, r.generation) for r in sorted(rows)] == [(i, f"p{i}") for i in range(60)]


def test_calls_are_spread_by_default(spark):
    df = spark.range(100).selectExpr("concat('p', id) AS prompt").coalesce(1)
    plan = inference.ask_lazily(df, [Ask("prompt", "g", ModelCall(echo, "m"))])
    assert plan.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_store_paths_with_patterns_are_refused(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "prompt string")
    with pytest.raises(ValueError):
        inference.generate_cached(df, "prompt", ModelCall(echo, "m"), f"{tmp_path}/st[o]re")


def test_cached_replies_and_a_hot_prompt(spark, tmp_path):
    # a third of the rows share a prompt: the join is one the planner may split, without limits
    df = spark.range(3000, numPartitions=8).selectExpr("sha2(string(id), 512) AS pad", "concat('p', if(id % 3 = 0, 0, id)) AS prompt")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = inference.generate_cached(df, "prompt", ModelCall(echo, "m", workers=8), str(tmp_path / "store"))
        assert got.count() == 3000
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert all(r.generation == f"m:{r.prompt}" for r in rows)
    assert "skew=true" in plan and "Limit" not in plan
    assert spark.read.parquet(str(tmp_path / "store")).count() == 2001


def test_a_batch_is_handed_over_whole():
    # a hand-over per call costs more than a quick call
    calls = ModelCall(echo, "m", workers=3)
    pool, puts = inference._Pool(calls), []
    put, pool.queue = pool.queue.put, type("Q", (), {"get": staticmethod(pool.queue.get), "put": staticmethod(lambda x: (puts.append(x), put(x)))})()
    batches = [pool.submit([f"{b}-{k}" for k in range(500)]) for b in range(3)] + [pool.submit([]), pool.submit([None])]
    answers = [b.wait() for b in batches]
    assert [[r[0] for r in a] for a in answers] == [[f"m:{b}-{k}" for k in range(500)] for b in range(3)] + [[], [None]]
    assert len(puts) == 3 * 3 + 1 and len(pool.threads) == 3
    pool.close()
    assert not any(t.is_alive() for t in pool.threads)


def test_only_distinct_prompts_are_hashed_for_the_store(spark, tmp_path, monkeypatch):
    plans = {}
    real = inference.materialize

    def seen(df, label, path=None):
        plans.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, label, path)

    monkeypatch.setattr(inference, "materialize", seen)
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "prompt string")
    rows = inference.generate_cached(df, "prompt", ModelCall(echo, "m"), f"{tmp_path}/store").collect()
    assert sorted(str(r.generation) for r in rows) == ["None", "m:a", "m:a", "m:b"]
    grouped, below = plans["wanted-prompts"].split("Aggregate [", 1)[1].split("\n", 1)
    assert "sha2" not in grouped.split("]")[0] and "sha2" not in below  # neither a grouping key nor worked out before
