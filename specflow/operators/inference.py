"""Batch inference: one model call per row, or per distinct prompt.

The model is a *client factory* the user supplies.  It is called once per
worker thread and returns ``chat(model=, messages=, options=, format=) -> str``.
Rows stream through the Python worker as Arrow batches, so all other columns
pass untouched and no join is needed to attach a reply.  The outcome is always
written before it is used: a model asked twice may answer twice.
"""

from __future__ import annotations

import json
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce
from itertools import count
from queue import SimpleQueue
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from specflow.functions.common import ColumnOrName, as_col
from specflow.operators import replies
from specflow.operators.columns import check_settings
from specflow.session import materialize

# --- fixed values -----------------------------------------------------------
GENERATOR_OPTIONS = {"temperature": 0.3, "num_predict": 1000}
# ----------------------------------------------------------------------------
HELD_BATCHES = 4  # batches that may wait for a slow call while later ones go on

CALLS_PER_TASK = 500  # calls a lost task has to make again at most


@dataclass(frozen=True)
class ModelCall:
    """How to ask a model.  ``workers`` calls of one task are in flight at a time."""

    client: Callable[[], Callable[..., str]]
    model: str
    system: str | None = None
    options: Mapping[str, Any] | None = None  # None: the default of the operator that asks
    response_format: str | None = None
    max_retries: int = 3
    backoff: float = 1.0
    workers: int = 1

    def __post_init__(self):
        options = self.options or {}
        check_settings(
            temperature=options.get("temperature"),
            max_tokens=options.get("num_predict"),
            workers=self.workers,
        )
        if self.max_retries < 0:
            raise ValueError("max_retries must not be negative")

    def sampling(self) -> dict[str, Any]:
        return dict(GENERATOR_OPTIONS if self.options is None else self.options)

    def identity(self) -> str:
        """Everything besides the prompt that decides the reply."""
        parts = [self.model, self.system, self.sampling(), self.response_format]
        return json.dumps(parts, sort_keys=True)


@dataclass(frozen=True)
class Ask:
    """One prompt column, the call to make with it and the columns to add."""

    prompt: ColumnOrName
    out: str
    call: ModelCall
    time_column: str | None = None
    details: bool = False

    def fields(self) -> list[t.StructField]:
        added = [t.StructField(self.out, t.StringType())]
        if self.time_column:
            added.append(t.StructField(self.time_column, t.DoubleType()))
        if self.details:
            added.append(t.StructField(f"{self.out}_error", t.StringType()))
            added.append(t.StructField(f"{self.out}_attempts", t.IntegerType()))
        return added


def generate(
    df: DataFrame,
    prompt: ColumnOrName,
    call: ModelCall,
    output_column: str = "generation",
    time_column: str | None = None,
    details: bool = False,
    partitions: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """Add the model's reply to each row's prompt; null after the last failed retry."""
    ask = Ask(prompt, output_column, call, time_column, details)
    return generate_all(df, [ask], partitions, path)


def generate_all(
    df: DataFrame, asks: list[Ask], partitions: int | None = None, path: str | None = None
) -> DataFrame:
    """Several generators over the same rows in one pass, their calls side by side.

    The rows are spread evenly over ``partitions`` tasks first, by default one
    per core or as many as keep a task below ``CALLS_PER_TASK`` rows; running tasks x
    ``workers`` is the load on the endpoint.  ``df`` is counted for that.
    """
    return materialize(ask_lazily(df, asks, partitions), "replies", path)


def generate_cached(
    df: DataFrame,
    prompt: ColumnOrName,
    call: ModelCall,
    store: str,
    output_column: str = "generation",
    time_column: str | None = None,
    partitions: int | None = None,
    refresh: bool = False,
    calls_per_task: int = CALLS_PER_TASK,
) -> DataFrame:
    """As ``generate``, but reuse replies kept in the store (see ``replies``).

    Each distinct prompt is asked once, only when the store lacks it.  The key covers
    the prompt and the whole ``identity`` of the call, so other settings never see
    it.  Failed calls are not kept.  Of the store only replies to this call are read,
    and only the folders that wanted keys belong to.

    A task makes ``calls_per_task`` calls or fewer on average (unless ``partitions`` says
    otherwise; keys are hashes, so tasks differ little) and its replies are in the store once it ends, so a lost task repeats
    its own calls and a run started again after a failure asks only what is missing.
    ``refresh`` asks all prompts anew; the store forgets what it had, of every call,
    when the new replies are complete.  ``df`` is read more than once; write it first
    if it is costly or not the same each time.
    """
    spark = df.sparkSession
    keyed = df.withColumn("__prompt", as_col(prompt)).withColumn("key", reply_key("__prompt", call))
    # a hash is costly and longer than many prompts: only distinct prompts get one here
    wanted = keyed.filter(F.col("__prompt").isNotNull()).select("__prompt").distinct()
    wanted = materialize(wanted.select(reply_key("__prompt", call).alias("key"), "__prompt"), "wanted-prompts")
    mark = replies.call_mark(call.identity())
    kept = [] if refresh else replies.batches(spark, store, mark)
    ready = replies.known(spark, kept, wanted)
    missing = wanted
    if ready is not None:
        ready = materialize(ready, "known-replies")
        missing = materialize(wanted.join(ready.select("key"), "key", "left_anti"), "missing-prompts")
    batch = replies.new_batch(store, mark)
    new_prompts = missing.count()
    if new_prompts and not refresh:
        # named before it is written: what its tasks finish counts even if this run is lost
        replies.change(spark, store, lambda now: [*now, batch])
    if new_prompts:
        tasks = partitions or _tasks_for(spark, new_prompts, calls_per_task)
        asked = ask_lazily(missing, [Ask("__prompt", "reply", call, "seconds", True)], tasks, "key")
        asked = asked.filter(F.col("reply").isNotNull()).select(
            "key", "reply", "seconds", F.col("reply_attempts").alias("attempts"), F.current_timestamp().alias("asked_at")
        )
        replies.write_batch(asked, batch, new_prompts)
    if refresh:
        replies.change(spark, store, lambda now: [batch] if new_prompts else [])
    new = replies.read_batches(spark, [batch]) if new_prompts else None
    parts = [t.select("key", F.col("reply").alias("__reply"), F.col("seconds").alias("__seconds")) for t in (ready, new) if t is not None]
    found = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "key string, __reply string, __seconds double")
    # one row per key against the rows as they are: the adaptive planner splits a frequent prompt
    joined = keyed.drop("__prompt").join(found, "key", "left")
    added = [F.col("__reply").alias(output_column)]
    if time_column:
        added.append(F.col("__seconds").alias(time_column))
    columns = [c for c in df.columns if c not in (output_column, time_column)]
    return joined.select(*columns, *added)


def _tasks_for(spark: SparkSession, calls: int, calls_per_task: int = CALLS_PER_TASK) -> int:
    """One task per core at least, and none with more than ``calls_per_task`` calls."""
    if calls_per_task <= 0:
        raise ValueError(f"calls_per_task must be positive, got {calls_per_task}")
    return max(spark.sparkContext.defaultParallelism, -(-calls // calls_per_task))


def reply_key(prompt: ColumnOrName, call: ModelCall) -> Column:
    return F.sha2(F.concat(F.lit(call.identity() + "\n"), as_col(prompt)), 256)


def ask_lazily(df: DataFrame, asks: list[Ask], partitions: int | None = None, near: str | None = None) -> DataFrame:
    """The unwritten plan behind ``generate``: every action on it calls the models again.

    Tasks hold rows at random, or equal ranges of ``near``, a column of hashes in hexadecimal.
    Hashes are spread evenly, so no borders have to be sampled through the driver.
    """
    kept = [c for c in df.columns if c not in {f.name for a in asks for f in a.fields()}]
    prompts = [f"__prompt{i}" for i in range(len(asks))]
    ready = df.select(
        *kept, *[as_col(a.prompt).cast("string").alias(p) for a, p in zip(asks, prompts)]
    )
    # calls are slow and a small table may be one partition: spread the rows over all cores, so thin
    # that a lost task repeats few calls; counting needs no column of a stored table
    tasks = partitions or _tasks_for(df.sparkSession, df.count())
    ready = ready.repartition(tasks) if near is None else ready.repartitionById(tasks, _range_of(near, tasks))
    schema = t.StructType(
        [f for f in ready.schema.fields if f.name in kept]
        + [f for a in asks for f in a.fields()]
    )
    return ready.mapInArrow(_task(asks, len(kept), schema.names), schema)


def _range_of(hashed: str, ranges: int) -> Column:
    """Which of so many equal ranges a hash in hexadecimal falls in, from its first eight digits."""
    return F.floor(F.conv(F.left(hashed, F.lit(8)), 16, 10).cast("long") * ranges / F.lit(1 << 32)).cast("int")


def _task(asks: list[Ask], kept: int, names: list[str]):
    shapes = [(a.call, a.time_column is not None, a.details) for a in asks]

    def finished(batch: pa.RecordBatch, pending: list[_Calls]) -> pa.RecordBatch:
        columns = batch.columns[:kept]
        for (_, timed, details), calls in zip(shapes, pending):
            answers = calls.wait()
            columns.append(pa.array([r[0] for r in answers], pa.string()))
            if timed:
                columns.append(pa.array([r[1] for r in answers], pa.float64()))
            if details:
                columns.append(pa.array([r[3] for r in answers], pa.string()))
                columns.append(pa.array([r[2] for r in answers], pa.int32()))
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pools = [_Pool(call) for call, _, _ in shapes]
        held: deque = deque()
        try:
            for batch in batches:  # all generators work on a batch side by side
                held.append((batch, [pool.submit(batch.column(kept + i).to_pylist()) for i, pool in enumerate(pools)]))
                while held and (len(held) > HELD_BATCHES or all(c.done.is_set() for c in held[0][1])):
                    yield finished(*held.popleft())
            while held:
                yield finished(*held.popleft())
        finally:
            for pool in pools:
                pool.close()

    return run


class _Calls:
    """The calls of one batch: each worker takes the next prompt that no other has taken."""

    def __init__(self, prompts: list[str | None]):
        self.prompts, self.answers = prompts, [None] * len(prompts)
        self.taken, self.ended = count(), count(1)  # a step of a counter is never shared by two threads
        self.done, self.error = threading.Event(), None
        if not prompts:
            self.done.set()

    def wait(self) -> list[tuple]:
        self.done.wait()
        if self.error is not None:
            raise self.error
        return self.answers


class _Pool:
    """Threads that each own a client and work through batches in their order.

    A batch is handed over whole, not call by call, since a hand-over costs more than a
    quick call; a slow call holds up its own thread and no later row.
    """

    def __init__(self, call: ModelCall):
        self.call, self.queue, self.threads = call, SimpleQueue(), []
        self.submitted, self.closed = 0, False

    def submit(self, prompts: list[str | None]) -> _Calls:
        calls = _Calls(prompts)
        self.submitted += len(prompts)
        for _ in range(min(self.call.workers, len(prompts))):  # as many threads as can take part
            self.queue.put(calls)
        while len(self.threads) < min(self.call.workers, self.submitted):
            self.threads.append(threading.Thread(target=self._work, daemon=True))
            self.threads[-1].start()
        return calls

    def close(self) -> None:
        """Calls under way end, no other begins."""
        self.closed = True
        for _ in self.threads:
            self.queue.put(None)
        for thread in self.threads:
            thread.join()

    def _work(self) -> None:
        own = threading.local()
        while (calls := self.queue.get()) is not None:
            size = len(calls.prompts)
            while not self.closed and (k := next(calls.taken)) < size:
                try:
                    calls.answers[k] = _ask_with_retry(self.call, own, calls.prompts[k])
                except BaseException as error:  # noqa: BLE001  raised again where the batch is waited for
                    calls.error = error
                if next(calls.ended) == size:
                    calls.done.set()


def _ask_with_retry(call: ModelCall, own, prompt: str | None):
    """(reply, seconds, attempts, error); waits 1, 2, 4 ... backoffs between attempts."""
    if prompt is None:
        return None, None, 0, "missing prompt"
    messages = [{"role": "user", "content": prompt}]
    if call.system:
        messages.insert(0, {"role": "system", "content": call.system})
    start = time.perf_counter()
    attempt = 0
    while True:
        try:
            if not hasattr(own, "chat"):
                own.chat = call.client()
            reply = own.chat(
                model=call.model,
                messages=messages,
                options=call.sampling(),
                format=call.response_format,
            )
            return reply, time.perf_counter() - start, attempt + 1, None
        except Exception as error:  # noqa: BLE001  one bad row must not fail the task
            if attempt >= call.max_retries:
                return None, time.perf_counter() - start, attempt + 1, str(error) or repr(error)
            time.sleep(call.backoff * 2**attempt)
            attempt += 1
