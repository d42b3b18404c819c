"""Joins of generations, tasks and model names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.functions.common import as_list, require_columns

def join_generations(
    a: DataFrame, b: DataFrame, key: str | Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """A's rows with ``columns`` of B, matched on a story key that is unique on both sides.

    Only needed when the two generators ran as separate jobs; in one job
    ``generate_all`` adds both replies to the same row.
    """
    keys = as_list(key)
    require_columns(a, keys, "join_generations")
    require_columns(b, [*keys, *columns], "join_generations")
    return a.join(b.select(*keys, *columns), keys, "inner")


def join_tasks(
    a: DataFrame, b: DataFrame, key: str = "us_id", carry: Sequence[str] = ("input",)
) -> DataFrame:
    """Full outer join of two exploded task tables on (``key``, ``task_id``).

    The pair is unique on both sides, so no key is hot.  Carried columns come
    from A, or from B where A has no such task.
    """
    both = [key, "task_id"]
    require_columns(a, [*both, *carry, "task_generator_a"], "join_tasks")
    require_columns(b, [*both, *carry, "task_generator_b"], "join_tasks")
    left = a.select(*both, *carry, "task_generator_a")
    right = b.select(*both, *[F.col(c).alias(f"__{c}") for c in carry], "task_generator_b")
    joined = left.join(right, both, "full_outer")
    filled = [F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) for c in carry]
    return joined.select(*both, *filled, "task_generator_a", "task_generator_b")


def with_model_names(df: DataFrame, experiments: DataFrame, config: str = "Config", gen: str = "Gen") -> DataFrame:
    """Add each generator's model name; configurations not listed drop out.

    ``experiments`` has one row per configuration (Config, G1, G2).  No hint is
    given: Spark sends it to every task only while it is small.
    """
    require_columns(experiments, ["Config", "G1", "G2"], "with_model_names")
    names = experiments.select(F.col("Config").alias(config), "G1", "G2")
    model = F.when(F.col(gen) == "G1", F.col("G1")).otherwise(F.col("G2"))
    return df.join(names, config, "inner").withColumn("Model", model).drop("G1", "G2")
