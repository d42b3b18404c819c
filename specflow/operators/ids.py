"""Running ids, batches and splits without a one-task window.

Rows are range-partitioned by their order, each partition numbers its own rows
while they are written, and the partition sizes give the offsets.  The written
table pins the numbering, so later reads and lost executors cannot change it.
Only one count per partition ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specflow.functions.common import ColumnOrName, as_col, as_list, require_columns
from specflow.session import materialize, partitions_for

CHUNK = "__chunk"
PLACE = "__place"
_TIE = "__tie"
_FROM = "__from"
# monotonically_increasing_id: partition number above these bits, row number below
_ROW_BITS = 33


def order_rows(
    df: DataFrame, keys: Sequence[ColumnOrName], unique: bool = False, partitions: int | None = None
) -> DataFrame:
    """Range-partition and sort by ``keys``, by default into as many parts as the bytes ask for.

    When the keys may tie, rows are also ordered by their content, and copies
    of one row by the partition they come from, so that a value or a group of
    copies that holds much of the table still spreads over many partitions.
    Both tie-breakers are the same again when a task is retried.
    """
    keys = [as_col(k) for k in as_list(keys)]
    order = list(keys)
    if not unique:
        df = df.withColumns({_TIE: F.xxhash64(*_hashable(df)), _FROM: F.spark_partition_id()})
        order += [F.col(_TIE), F.col(_FROM)]
    n = partitions or partitions_for(df)
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order).drop(_TIE, _FROM)


def _hashable(df: DataFrame) -> list[Column]:
    return [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def number_rows(df: DataFrame, label: str) -> DataFrame:
    """Write rows with their partition (``__chunk``) and place in it (``__place``, from 0)."""
    mark = F.monotonically_increasing_id()
    numbered = df.withColumn(PLACE, mark).withColumns(
        {
            CHUNK: F.shiftright(F.col(PLACE), _ROW_BITS).cast("int"),
            PLACE: F.col(PLACE).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    return materialize(numbered, label)


def chunk_starts(numbered: DataFrame) -> DataFrame:
    """Rows before each partition: one row per partition, so safe to broadcast."""
    sizes = {
        row[CHUNK]: row["n"]
        for row in numbered.groupBy(CHUNK).agg((F.max(PLACE) + 1).alias("n")).collect()
    }
    chunks = sorted(sizes)
    starts = accumulate((sizes[c] for c in chunks[:-1]), initial=0)
    rows = list(zip(chunks, starts)) if chunks else []
    return numbered.sparkSession.createDataFrame(rows, f"{CHUNK} int, __start long")


def dense_id(
    df: DataFrame,
    order_by: Sequence[ColumnOrName],
    id_col: str = "us_id",
    unique: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Add a running id 1..n in the order of ``order_by``.

    ``unique`` promises that the keys never tie and saves hashing the rows.
    """
    ordered = order_rows(df, order_by, unique, partitions)
    numbered = number_rows(ordered, f"ids-{id_col}")
    joined = numbered.join(F.broadcast(chunk_starts(numbered)), CHUNK)
    columns = [c for c in df.columns if c != id_col]
    return joined.select(*columns, (F.col("__start") + F.col(PLACE) + 1).alias(id_col))


def batch_id(running_id: ColumnOrName, batch_size: int) -> Column:
    """Number (from 0) of the slice of ``batch_size`` consecutive ids a row falls in."""
    if batch_size <= 0:
        raise ValueError("batch_size must be greater than 0")
    return F.floor((as_col(running_id) - 1) / F.lit(batch_size)).cast("long")


def split_id(running_id: ColumnOrName, splits: int) -> Column:
    """Part (from 0) of a stride split into ``splits`` parts."""
    if splits <= 0:
        raise ValueError("splits must be greater than 0")
    return F.pmod(as_col(running_id) - 1, F.lit(splits)).cast("long")


def batch_count(df: DataFrame, batch_size: int) -> DataFrame:
    """One row: how many batches of ``batch_size`` the rows fill."""
    if batch_size <= 0:
        raise ValueError("batch_size must be greater than 0")
    batches = F.ceil(F.count(F.lit(1)) / F.lit(batch_size)).cast("long")
    return df.agg(batches.alias("num_batches"))


def running_total_before(
    df: DataFrame,
    group: str,
    order_by: Sequence[ColumnOrName],
    amount: Column,
    name: str,
    partitions: int | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add, per group, the sum of ``amount`` over the rows before this one.

    A window over the whole group would put a large group into one task.  Here
    the order cuts a group into chunks; the window runs inside (group, chunk)
    and a chunk starts from the sum of the group's earlier chunks.  A chunk
    border cuts at most one group, so there are fewer such starts than chunks.
    ``prepare`` adds what ``amount`` needs; it runs once the rows are in place,
    as finding the range borders reads the input an extra time.
    """
    require_columns(df, [group], "running_total_before")
    keys = [F.col(group), *as_list(order_by)]
    tie = F.xxhash64(*_hashable(df))
    chunked = order_rows(df, keys, partitions=partitions).withColumn(CHUNK, F.spark_partition_id())
    if prepare is not None:
        chunked = prepare(chunked.withColumn(_TIE, tie))
        tie = F.col(_TIE)
    columns = [c for c in chunked.columns if c not in (name, CHUNK, _TIE)]
    chunked = chunked.withColumn("__amount", amount.cast("long"))
    inside = (
        Window.partitionBy(group, CHUNK)
        .orderBy(*as_list(order_by), tie)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = chunked.withColumn(name, F.coalesce(F.sum("__amount").over(inside), F.lit(0)))
    kept = materialize(summed, f"running-{name}")
    earlier = Window.partitionBy("__g").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        kept.groupBy(F.col(group).alias("__g"), CHUNK)
        .agg(F.sum("__amount").alias("__sum"))
        .withColumn("__start", F.sum("__sum").over(earlier))
        .filter(F.col("__start").isNotNull())
        .select("__g", F.col(CHUNK).alias("__c"), "__start")
    )
    same = F.col(group).eqNullSafe(F.col("__g")) & (F.col(CHUNK) == F.col("__c"))
    joined = kept.join(F.broadcast(starts), same, "left")
    total = F.col(name) + F.coalesce(F.col("__start"), F.lit(0))
    return joined.select(*columns, total.alias(name))
