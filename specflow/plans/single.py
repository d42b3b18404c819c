"""One generator: stories -> ids -> tasks -> optional judge."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import DataFrame

from specflow.functions.common import ColumnOrName
from specflow.functions.prompts import task_prompt
from specflow.operators import columns, ids, inference, judging, parsing, report, stories, tasks
from specflow.sources import writers

PARSE_STATUS = "judge_parse_status"
SYSTEM = (
    "You lead a software development team and break user stories down into clear tasks "
    "a developer can act on."
)


def run_single(
    df: DataFrame,
    call: inference.ModelCall,
    order_by: Sequence[ColumnOrName],
    story: str = "input",
    judge_call: inference.ModelCall | None = None,
    threshold: float = judging.THRESHOLD,
    sample_size: int | None = None,
    partitions: int | None = None,
    prompt: ColumnOrName | None = None,
    judge_prompt: ColumnOrName | None = None,
    case_sensitive: bool = False,
    policy: str = "model",
    zero_retries: int = judging.ZERO_RETRIES,
) -> DataFrame:
    """Clean and validate stories, number them, generate tasks, explode them, judge each task.

    Task numbers run over the whole table.  With ``judge_call`` every task row
    is scored against its story; the judge sees columns ``story`` and ``task``.
    Prompts default to the package's own texts.
    """
    columns.check_settings(threshold=threshold)
    if call.system is None:
        call = replace(call, system=SYSTEM)
    cleaned = columns.clean_text_rows(df, story, sample_size, order_by)
    valid = stories.valid_stories(cleaned, story, case_sensitive)
    numbered = ids.dense_id(valid, order_by, "us_id", partitions=partitions)
    named = columns.add_constant(numbered, "generator_model_name", call.model)
    asked = task_prompt(story) if prompt is None else prompt
    answered = inference.generate(named, asked, call, "tasks", partitions=partitions)
    exploded = tasks.explode_tasks(answered, order_by=["us_id"], unique_order=True)
    if judge_call is not None:
        exploded = columns.add_constant(exploded, "judge_model_name", judge_call.model)
        exploded = judging.judge(
            exploded,
            story,
            "task",
            judge_call,
            threshold,
            policy,
            prompt=judge_prompt,
            zero_retries=zero_retries,
            partitions=partitions,
            parse_status=PARSE_STATUS,
        )
    return columns.move_first(exploded, "us_id")


class SingleReport(NamedTuple):
    counts: DataFrame
    approval: DataFrame
    parsing: DataFrame


def report_single(result: DataFrame) -> SingleReport:
    """Tasks and stories, approval and how the answers parsed, of a judged run."""
    return SingleReport(
        report.task_counts(result), report.approval_report(result), parsing.parse_metrics(result, PARSE_STATUS)
    )


def write_single(result: DataFrame, folder: str, timestamp: str | None = None, fmt: str = "csv") -> str:
    """The task table of a run under a name of its own."""
    suffix = ".csv" if fmt == "csv" else ""
    return writers.write_tasks(result, writers.run_path(folder, "single_tasks", suffix, timestamp), fmt)
