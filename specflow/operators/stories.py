"""User-story validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.functions.common import ColumnOrName, require_columns
from specflow.functions.text import is_story


def flag_stories(
    df: DataFrame, story_column: str, case_sensitive: bool = False, flag: str = "story_valid"
) -> DataFrame:
    """All rows, with whether the story has the agreed format."""
    require_columns(df, [story_column], "flag_stories")
    return df.withColumn(flag, is_story(story_column, case_sensitive))


def valid_stories(df: DataFrame, story_column: str, case_sensitive: bool = False) -> DataFrame:
    """Rows whose story has the agreed format; text and other columns unchanged."""
    require_columns(df, [story_column], "valid_stories")
    return df.filter(is_story(story_column, case_sensitive))


def validation_stats(df: DataFrame, story_column: str, case_sensitive: bool = False) -> DataFrame:
    """One row: total, valid and invalid stories and their percentages (null for no rows)."""
    flagged = flag_stories(df, story_column, case_sensitive)
    counts = flagged.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("story_valid").alias("valid")
    ).withColumn("invalid", F.col("total") - F.col("valid"))
    percent = lambda c: F.try_divide(F.col(c) * F.lit(100.0), F.col("total"))
    return counts.withColumns({"valid_pct": percent("valid"), "invalid_pct": percent("invalid")})


def reject_sample(
    df: DataFrame,
    story_column: str,
    order_by: Sequence[ColumnOrName],
    n: int = 3,
    case_sensitive: bool = False,
) -> DataFrame:
    """The first ``n`` stories that fail, in the given order (a top-n, not a sort)."""
    require_columns(df, [story_column], "reject_sample")
    return df.filter(~is_story(story_column, case_sensitive)).orderBy(*order_by).limit(n)
