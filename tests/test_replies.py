"""The store of replies: versions, pruning, forgetting, and runs that break off."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from specflow.operators import inference, replies
from specflow.operators.inference import ModelCall
from specflow.session import paths_like, publish_text


def counting(folder, breaks_at=None, flag=None):
    def client():
        def chat(model, messages, options, format):
            prompt = messages[-1]["content"]
            if prompt == breaks_at and not os.path.exists(flag):
                until = time.time() + 30
                while len(os.listdir(folder)) < 90 and time.time() < until:
                    time.sleep(0.1)
                time.sleep(2)  # tasks that are done have written their files
                open(flag, "w").close()
                os._exit(1)  # the worker dies, as on a lost executor
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(prompt)
            return f"{model}: {prompt}"

        return chat

    return client


def asked(folder):
    return [open(f"{folder}/{name}").read() for name in os.listdir(folder)]


@pytest.fixture
def calls(tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    return str(folder)


def prompts(spark, n):
    return spark.range(n).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt"))


def test_only_wanted_prefixes_of_one_call_are_read(spark, tmp_path, calls, monkeypatch):
    monkeypatch.setattr(replies, "ROWS_PER_PREFIX", 2)
    assert [replies.digits_for(n) for n in (0, 2, 3, 32, 33, 512, 513, 10**9)] == [0, 0, 1, 1, 2, 2, 3, 3]
    store = f"{tmp_path}/store"
    call, other = ModelCall(counting(calls), "m"), ModelCall(counting(calls), "other")
    inference.generate_cached(prompts(spark, 300), "prompt", call, store)
    inference.generate_cached(prompts(spark, 300), "prompt", other, store)
    mark = replies.call_mark(call.identity())
    kept = replies.batches(spark, store, mark)
    assert len(kept) == 1 and len(replies.batches(spark, store)) == 2
    wanted = prompts(spark, 2).select(inference.reply_key("prompt", call).alias("key"))
    found = replies.known(spark, kept, wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "prefix" in filters and plan.count("FileScan") >= 1
    prefixes = {r[0] for r in wanted.select(replies.prefix_of("key", 2)).collect()}
    table = replies.read_batches(spark, kept, sorted(prefixes))
    read = table.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    assert 0 < read < replies.read_batches(spark, kept).select(F.col("_metadata.file_path").alias("f")).distinct().count() / 10
    assert sorted(r.reply for r in found.collect()) == ["m: p0", "m: p1"]


def test_forgetting_one_call(spark, tmp_path, calls):
    store = f"{tmp_path}/store"
    call, other = ModelCall(counting(calls), "m"), ModelCall(counting(calls), "other")
    df = prompts(spark, 5)
    for c in (call, other):
        inference.generate_cached(df, "prompt", c, store)
    assert replies.forget(spark, store, call.identity()) == 1
    assert replies.stored(spark, store, call.identity()).count() == 0 and replies.stored(spark, store).count() == 5
    assert len(asked(calls)) == 10
    inference.generate_cached(df, "prompt", other, store).collect()
    assert len(asked(calls)) == 10
    inference.generate_cached(df, "prompt", call, store).collect()
    assert len(asked(calls)) == 15
    assert replies.forget(spark, store) == 2 and replies.stored(spark, store).count() == 0
    assert replies.forget(spark, store) == 0 and replies.forget(spark, f"{tmp_path}/none") == 0


def test_a_refresh_lost_before_the_swap_leaves_the_old_replies(spark, tmp_path, calls, monkeypatch):
    store = f"{tmp_path}/store"
    call = ModelCall(counting(calls), "m")
    inference.generate_cached(prompts(spark, 4), "prompt", call, store)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(replies, "change", lost)
        with pytest.raises(RuntimeError, match="lost"):
            inference.generate_cached(prompts(spark, 4), "prompt", call, store, refresh=True)
    assert len(asked(calls)) == 8
    assert sorted(r.reply for r in replies.stored(spark, store).collect()) == [f"m: p{k}" for k in range(4)]
    inference.generate_cached(prompts(spark, 4), "prompt", call, store).collect()
    assert len(asked(calls)) == 8
    inference.generate_cached(prompts(spark, 2), "prompt", call, store, refresh=True).collect()
    assert replies.stored(spark, store).count() == 2
    assert replies.clean(spark, store) == 2  # the first batch and the lost one
    assert replies.stored(spark, store).count() == 2 and len(paths_like(spark, f"{store}/_version-*")) == 1


def test_a_run_that_breaks_off_late_keeps_finished_tasks(spark, tmp_path, calls):
    store, n, each = f"{tmp_path}/store", 120, 10
    call = ModelCall(counting(calls, "p77", f"{tmp_path}/broken"), "m")
    with pytest.raises(Exception, match="crashed|exited|EOF|Job aborted|Connection"):
        inference.generate_cached(prompts(spark, n), "prompt", call, store, calls_per_task=each).collect()
    before = len(asked(calls))
    saved = replies.stored(spark, store).count()
    assert saved > 0
    rows = inference.generate_cached(prompts(spark, n), "prompt", call, store, calls_per_task=each).collect()
    assert sorted(r.generation for r in rows) == sorted(f"m: p{k}" for k in range(n))
    assert len(asked(calls)) - before == n - saved  # only what no finished task had asked
    again = asked(calls)
    running = spark.sparkContext.defaultParallelism
    assert len(again) - len(set(again)) <= each * running  # of the tasks that ran at the time


def test_tasks_are_bounded(spark, calls):
    call = ModelCall(counting(calls), "m")
    asks = [inference.Ask("prompt", "out", call)]
    assert inference.ask_lazily(prompts(spark, 30), asks).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = inference.ask_lazily(prompts(spark, 20 * inference.CALLS_PER_TASK), asks)
    assert many.rdd.getNumPartitions() == 20
    with pytest.raises(ValueError, match="calls_per_task"):
        inference.generate_cached(prompts(spark, 3), "prompt", call, "/tmp/never", calls_per_task=0)


def test_tasks_of_new_replies_are_ranges_of_keys_without_a_sample(spark, calls):
    call = ModelCall(counting(calls), "m")
    keyed = prompts(spark, 2000).withColumn("key", inference.reply_key("prompt", call))
    asked = inference.ask_lazily(keyed, [inference.Ask("prompt", "out", call)], 40, "key")
    plan = asked._jdf.queryExecution().optimizedPlan().toString()
    # borders of ranges would be found in a sample of all keys that the driver gathers
    assert "rangepartitioning" not in asked._jdf.queryExecution().executedPlan().toString()
    assert "RepartitionByExpression" in plan
    parts = asked.groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"))
    parts = parts.orderBy("part").collect()
    assert [p.part for p in parts] == list(range(40)) and sum(p.n for p in parts) == 2000
    assert all(a.high < b.low for a, b in zip(parts, parts[1:])) and max(p.n for p in parts) < 90


def test_compaction_keeps_every_reply_once(spark, tmp_path, calls):
    store = f"{tmp_path}/store"
    call, other = ModelCall(counting(calls), "m"), ModelCall(counting(calls), "other")
    for n in (3, 6, 9):
        inference.generate_cached(prompts(spark, n), "prompt", call, store)
    inference.generate_cached(prompts(spark, 2), "prompt", other, store)
    before = sorted(replies.stored(spark, store).collect())
    replies.compact(spark, store)
    assert len(replies.batches(spark, store)) == 2
    assert sorted(replies.stored(spark, store).collect()) == before and len(before) == 11
    replies.clean(spark, store)
    assert sorted(replies.stored(spark, store).collect()) == before
    inference.generate_cached(prompts(spark, 9), "prompt", call, store).collect()
    assert len(asked(calls)) == 11


def test_versions_are_taken_once(spark, tmp_path):
    assert publish_text(spark, f"{tmp_path}/s/version-1", "[]")
    assert not publish_text(spark, f"{tmp_path}/s/version-1", "other")
    assert (tmp_path / "s/version-1").read_text() == "[]"
    assert [p.rsplit("/", 1)[1] for p in paths_like(spark, f"{tmp_path}/s/*")] == ["version-1"]
    with pytest.raises(ValueError, match="plain path"):
        replies.stored(spark, f"{tmp_path}/a*")
    # another run takes the next number between reading and publishing: the change is made anew
    store, meet = f"{tmp_path}/t", []

    def edit(now):
        if not meet:
            meet.append(1)
            replies.change(spark, store, lambda at: [*at, replies.Batch(f"{store}/batch=x", "x")])
        return [*now, replies.Batch(f"{store}/batch=y", "y")]

    replies.change(spark, store, edit)
    assert [b.call for b in replies.batches(spark, store)] == ["x", "y"]
