"""Replies of models kept between runs, as a table in versions.

    <store>/batch=<id>/prefix=k3f/*.parquet   replies of one run to one kind of call, by the beginning of their key
    <store>/_version-0000000007               one line of JSON: the batches that count and the call of each

The version with the highest number holds.  A version appears under its name
complete, by one rename that fails if the name is taken, so readers see the old state or
the new one and a run that is lost leaves the old one.  Batches of other calls are not
read at all, and of the others only the folders of wanted prefixes.

A key is a hash, so its first digits spread any set of prompts evenly.  How many of them
make the prefixes of a batch depends on its size, so small batches are few files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specflow.session import first_line, hadoop_path, materialize, partitions_for, paths_like, publish_text

REPLY = "key string, reply string, seconds double, attempts int, asked_at timestamp"
ROWS_PER_PREFIX = 5_000
MOST_DIGITS = 3
TRIES = 20


class Batch(NamedTuple):
    folder: str
    call: str


def check_store(store: str) -> str:
    if any(c in store for c in "[]{}*?\\"):
        raise ValueError(f"store must be a plain path, without pattern characters: {store!r}")
    return store.rstrip("/")


def digits_for(rows: int) -> int:
    """Fewest digits that leave about ``ROWS_PER_PREFIX`` rows to a prefix."""
    return next((d for d in range(MOST_DIGITS) if rows <= ROWS_PER_PREFIX * 16**d), MOST_DIGITS)


def prefix_of(key: Column | str, digits: int) -> Column:
    return F.concat(F.lit("k"), F.left(key, F.lit(digits)))


def new_batch(store: str, call: str) -> Batch:
    return Batch(f"{check_store(store)}/batch={uuid.uuid4().hex}", call)


def _versions(spark: SparkSession, store: str) -> list[str]:
    return paths_like(spark, f"{check_store(store)}/_version-*")


def batches(spark: SparkSession, store: str, call: str | None = None) -> list[Batch]:
    """The batches that count, all or those of one call."""
    versions = _versions(spark, store)
    if not versions:
        return []
    found = [Batch(f"{check_store(store)}/{name}", of) for name, of in json.loads(first_line(spark, versions[-1]))]
    return [b for b in found if call is None or b.call == call]


def change(spark: SparkSession, store: str, edit: Callable[[list[Batch]], list[Batch]]) -> list[Batch]:
    """Make ``edit`` of the current batches the next version; made anew if another run was faster."""
    for _ in range(TRIES):
        versions = _versions(spark, store)
        number = int(versions[-1].rsplit("-", 1)[1]) + 1 if versions else 1
        wanted = edit(batches(spark, store))
        text = json.dumps([(b.folder.rsplit("/", 1)[1], b.call) for b in wanted])
        if publish_text(spark, f"{check_store(store)}/_version-{number:010d}", text):
            return wanted
    raise RuntimeError(f"{store} changes all the time")


def write_batch(replies: DataFrame, batch: Batch, rows: int) -> None:
    """Write about ``rows`` replies (``REPLY``) as a batch; best if a task holds keys that follow each other.

    Files of a finished task stay even if the job fails later, so a lost run has
    to ask only what its unfinished tasks were asking.
    """
    keyed = replies.withColumn("prefix", prefix_of("key", digits_for(rows)))
    keyed.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("prefix").parquet(batch.folder)


def read_batches(spark: SparkSession, some: list[Batch], prefixes: list[str] | None = None) -> DataFrame | None:
    """Rows of ``REPLY`` and ``prefix``; of some prefixes only, if given.  None if nothing was written."""
    folders = [b.folder for b in some if paths_like(spark, f"{b.folder}/prefix=*")]
    if not folders:
        return None
    root = some[0].folder.rsplit("/", 1)[0]
    table = spark.read.schema(f"{REPLY}, batch string, prefix string").option("basePath", root).parquet(*folders).drop("batch")
    return table if prefixes is None else table.where(F.col("prefix").isin(*prefixes))


def first_replies(table: DataFrame) -> DataFrame:
    """One reply per key: two runs at the same time may both have asked, the first counts."""
    first = F.min(F.struct("asked_at", "reply", "seconds", "attempts")).alias("r")
    return table.groupBy("key").agg(first).select("key", "r.reply", "r.seconds", "r.attempts", "r.asked_at")


def known(spark: SparkSession, some: list[Batch], wanted: DataFrame) -> DataFrame | None:
    """Replies to the keys of ``wanted`` (key); only folders of their prefixes are read."""
    if not some:
        return None
    longest = {r[0] for r in wanted.select(prefix_of("key", MOST_DIGITS)).distinct().collect()}  # at most 16 ** MOST_DIGITS
    table = read_batches(spark, some, sorted({p[: 1 + d] for p in longest for d in range(MOST_DIGITS + 1)}))
    return None if table is None else first_replies(table.join(wanted.select("key"), "key", "left_semi"))


def stored(spark: SparkSession, store: str, call: str | None = None) -> DataFrame:
    """All replies of the store, or those to one call (``ModelCall.identity``), one per key."""
    table = read_batches(spark, batches(spark, store, call_mark(call)))
    return spark.createDataFrame([], REPLY) if table is None else first_replies(table)


def call_mark(identity: str | None) -> str | None:
    """Short name of a call's identity."""
    return None if identity is None else uuid.uuid5(uuid.NAMESPACE_OID, identity).hex


def forget(spark: SparkSession, store: str, call: str | None = None) -> int:
    """Drop all replies, or those to one call (``ModelCall.identity``); returns how many batches went.

    Only the version changes; ``clean`` deletes the files.
    """
    mark = call_mark(call)
    before = batches(spark, store)
    gone = [b for b in before if mark is None or b.call == mark]
    if gone:
        change(spark, store, lambda now: [b for b in now if b not in gone])
    return len(gone)


def compact(spark: SparkSession, store: str) -> None:
    """One batch per call instead of many, one reply per key, a file or so per prefix.

    Batches that other runs add meanwhile stay as they are.
    """
    now = batches(spark, store)
    for call in sorted({b.call for b in now}):
        old = [b for b in now if b.call == call]
        table = read_batches(spark, old) if len(old) > 1 else None
        if table is None:
            continue
        one = new_batch(store, call)
        whole = materialize(first_replies(table), "compacted-replies")
        rows = whole.count()
        write_batch(whole.repartitionByRange(partitions_for(whole), "key"), one, rows)
        change(spark, store, lambda at, old=old, one=one: [one if b == old[0] else b for b in at if b not in old[1:]])


def clean(spark: SparkSession, store: str) -> int:
    """Delete batches and versions the current version does not need; returns how many batches went.

    Not while another run uses the store.
    """
    keep = {b.folder.rsplit("/", 1)[1] for b in batches(spark, store)}
    gone = [p for p in paths_like(spark, f"{check_store(store)}/batch=*") if p.rsplit("/", 1)[1] not in keep]
    for path in gone + _versions(spark, store)[:-1]:
        fs, place = hadoop_path(spark, path)
        fs.delete(place, True)
    return len(gone)
