"""Sinks.  Parquet unless CSV is asked for; a path is a folder of part files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.functions.common import require_columns
from specflow.operators.report import sort_and_round
from specflow.operators.stories import valid_stories
from specflow.sources.readers import JUDGE_RESULT_COLUMNS, RESULT_SUFFIX


def run_path(folder: str, base: str, suffix: str = ".csv", timestamp: str | None = None) -> str:
    """``<folder>/<base>_<timestamp><suffix>``, so that runs do not overwrite each other."""
    stamp = timestamp or datetime.now().strftime("%Y%m%d_%H%M%S")
    return f"{folder.rstrip('/')}/{base}_{stamp}{suffix}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> str:
    """Write a table; nested columns become JSON text in CSV."""
    if fmt == "csv":
        nested = {
            f.name: F.to_json(f.name)
            for f in df.schema.fields
            if f.dataType.typeName() in ("array", "map", "struct")
        }
        df.withColumns(nested).write.mode(mode).options(
            header=True,
            quote='"',
            escape='"',
            # the writer would otherwise strip the cells
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        ).csv(path)
    elif fmt == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"format must be 'parquet' or 'csv', got {fmt!r}")
    return path


def write_tasks(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> str:
    return write_table(df, path, fmt, mode)


def write_judge_results(
    df: DataFrame, folder: str, stem: str, fmt: str = "parquet", mode: str = "error"
) -> str:
    """The fixed judge-result columns, as ``<stem>_judge_results``."""
    require_columns(df, JUDGE_RESULT_COLUMNS, "write_judge_results")
    suffix = ".csv" if fmt == "csv" else ""
    path = f"{folder.rstrip('/')}/{stem}{RESULT_SUFFIX}{suffix}"
    return write_table(df.select(*JUDGE_RESULT_COLUMNS), path, fmt, mode)


def write_valid(
    df: DataFrame,
    story_column: str,
    folder: str = "data",
    filename: str | None = None,
    case_sensitive: bool = False,
) -> str | None:
    """Export the valid stories with all columns as CSV; nothing when there are none."""
    valid = valid_stories(df, story_column, case_sensitive)
    if valid.isEmpty():
        return None
    path = f"{folder.rstrip('/')}/{filename}" if filename else run_path(folder, "validated_stories")
    return write_table(valid, path, "csv")


def write_summary(summary: DataFrame, path: str, mode: str = "error") -> str:
    """A report (a few rows per configuration) as one sorted, rounded CSV file."""
    ordered = sort_and_round(summary)
    ordered.coalesce(1).sortWithinPartitions("Config", "Gen").write.mode(mode).option(
        "header", True
    ).csv(path)
    return path
