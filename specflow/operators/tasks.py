"""Numbered answers -> one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.functions import text as T
from specflow.functions.common import ColumnOrName, require_columns, settle
from specflow.operators.ids import (
    CHUNK,
    PLACE,
    chunk_starts,
    number_rows,
    order_rows,
    running_total_before,
)

_STEPS = ("__text", "__numbered", "__labelled", "__lettered")


def split_tasks(df: DataFrame, tasks_column: str, out: str = "task_list") -> DataFrame:
    """Add the array of task texts found in an answer, markers still on.

    Cut before numbered ``summary:`` lines; when that gives fewer than two
    tasks, before bare ``summary:`` lines; then before lines like ``a) 4.2.``.
    Each fallback runs only for the rows that need it.  An answer without any
    task is kept whole as one; a null answer gives one null task.
    """
    require_columns(df, [tasks_column], "split_tasks")
    return _list_tasks(df, tasks_column, out).withColumn(out, F.transform(out, T.strip))


def _list_tasks(df: DataFrame, tasks_column: str, out: str) -> DataFrame:
    """``split_tasks`` with blanks left at the ends of the pieces."""
    text, numbered, labelled, lettered = (F.col(c) for c in _STEPS)
    few = F.size(numbered) < 2
    still_few = few & (F.size(labelled) < 2)
    staged = df.withColumn("__text", T.strip(F.col(tasks_column).cast("string")))
    for name, needed, line_break, start in (
        ("__numbered", F.lit(True), T.NUMBERED_BREAK, T.NUMBERED_START),
        ("__labelled", few, T.LABEL_BREAK, T.LABEL_START),
        ("__lettered", still_few, T.LETTERED_BREAK, T.LETTERED_START),
    ):
        staged = staged.withColumn(name, F.when(needed, T.cut_before(text, line_break)))
        staged = staged.withColumn(name, T.without_preamble(name, start))
    found = (
        F.when(text.isNull(), F.array(F.lit(None).cast("string")))
        .when(~few, numbered)
        .when(~still_few, labelled)
        .when(F.size(lettered) >= 2, lettered)
        .when(F.size(numbered) == 1, numbered)
        .otherwise(F.array(text))
    )
    return settle(staged.withColumn(out, found).drop(*_STEPS), [out])


def explode_tasks(
    df: DataFrame,
    tasks_column: str = "tasks",
    output_column: str = "task",
    task_id_column: str = "task_id",
    group_by: str | None = None,
    order_by: Sequence[ColumnOrName] = (),
    unique_group: bool = False,
    unique_order: bool = False,
    strict_numbers: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """One row per task with its number, other columns repeated.

    Without ``group_by`` the number runs over the whole table in ``order_by``
    order (``unique_order`` promises that order has no ties).  With it the number restarts per group; ``unique_group`` promises
    that a group is a single row, in which case the number is just the place in
    the answer and nothing is shuffled.
    """
    require_columns(df, [tasks_column, *([group_by] if group_by else [])], "explode_tasks")
    kept = [
        c
        for c in df.columns
        if c not in (task_id_column, output_column)
        and not (c == tasks_column and tasks_column != output_column)
    ]
    if group_by is None:
        if not order_by:
            raise ValueError("explode_tasks: a number over the whole table needs order_by")
        ordered = _list_tasks(order_rows(df, order_by, unique_order, partitions), tasks_column, "__tasks")
        exploded = ordered.select(*kept, F.explode_outer("__tasks").alias("__task"))
        numbered = number_rows(exploded, "tasks")
        source = numbered.join(F.broadcast(chunk_starts(numbered)), CHUNK)
        number = F.col("__start") + F.col(PLACE) + 1
    elif unique_group:
        listed = _list_tasks(df, tasks_column, "__tasks")
        source = listed.select(*kept, F.posexplode_outer("__tasks").alias("__place", "__task"))
        number = F.col("__place").cast("long") + 1
    else:
        if not order_by:
            raise ValueError("explode_tasks: groups of several rows need order_by")

        def listed_only(ordered: DataFrame) -> DataFrame:
            listed = _list_tasks(ordered, tasks_column, "__tasks")
            return listed if tasks_column in kept else listed.drop(tasks_column)

        before = running_total_before(
            df, group_by, order_by, F.size("__tasks"), "__before", partitions, listed_only
        )
        source = before.select(*kept, "__before", F.posexplode_outer("__tasks").alias("__place", "__task"))
        number = F.col("__before") + F.col("__place") + 1
    bare = T.without_marker("__task", strict_numbers)
    numbered_tasks = source.select(*kept, number.alias(task_id_column), bare.alias(output_column))
    return numbered_tasks.withColumn(output_column, T.without_bold(output_column))


def task_fields(df: DataFrame, task_column: str = "task") -> DataFrame:
    """Add ``task_summary`` and ``task_description`` from the two labels of a task."""
    require_columns(df, [task_column], "task_fields")
    return df.withColumns(
        {
            "task_summary": T.task_summary(task_column),
            "task_description": T.task_description(task_column),
        }
    )


def compare_tasks(
    df: DataFrame,
    tasks_a: str = "tasks_generator_a",
    tasks_b: str = "tasks_generator_b",
    key: str = "us_id",
    carry: Sequence[str] = ("input",),
) -> DataFrame:
    """Tasks of two generators side by side, for a table with one row per ``key``.

    Both answers are in the same row, so pairing task n of A with task n of B
    needs no join: the two lists are zipped and exploded together.
    """
    require_columns(df, [key, tasks_a, tasks_b, *carry], "compare_tasks")
    listed = _list_tasks(_list_tasks(df, tasks_a, "__a"), tasks_b, "__b")
    zipped = listed.select(
        key, *carry, F.posexplode_outer(F.arrays_zip("__a", "__b")).alias("__place", "__pair")
    )
    paired = zipped.select(
        key,
        (F.col("__place").cast("long") + 1).alias("task_id"),
        *carry,
        T.without_marker("__pair.__a").alias("task_generator_a"),
        T.without_marker("__pair.__b").alias("task_generator_b"),
    )
    return paired.withColumns(
        {c: T.without_bold(c) for c in ("task_generator_a", "task_generator_b")}
    )


def count_compared(
    df: DataFrame, tasks_a: str = "tasks_generator_a", tasks_b: str = "tasks_generator_b", out: str = "tasks"
) -> DataFrame:
    """Add how many rows ``compare_tasks`` makes of each row."""
    require_columns(df, [tasks_a, tasks_b], "count_compared")
    listed = _list_tasks(_list_tasks(df, tasks_a, "__a"), tasks_b, "__b")
    return listed.withColumn(out, F.greatest(F.size("__a"), F.size("__b"))).drop("__a", "__b")
