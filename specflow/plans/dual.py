"""Two generators and a pair judge."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.functions.common import ColumnOrName
from specflow.functions.prompts import task_prompt
from specflow.operators import columns, ids, inference, judging, report, stories, tasks
from specflow.session import materialize
from specflow.sources import writers
from specflow.sources.readers import JUDGE_RESULT_COLUMNS

# --- fixed values -----------------------------------------------------------
SECOND_OPTIONS = {"temperature": 0.7, "num_predict": 1000}
JUDGE_OPTIONS = {"temperature": 0.2, "num_predict": 800}
# ----------------------------------------------------------------------------


class DualReport(NamedTuple):
    counts: DataFrame
    wins: DataFrame
    criteria: DataFrame
    timings: DataFrame


class DualResult(NamedTuple):
    tasks: DataFrame
    judged: DataFrame

    def report(self) -> DualReport:
        """Tasks and stories, wins and mean totals, criterion means and mean seconds of the run.

        One aggregate over the judged rows gives all of it; its one row is written.
        """
        counted = tasks.count_compared(self.judged)
        figures = materialize(report.run_figures(counted), "run-figures")
        named = [c.capitalize() for c in columns.CRITERIA]
        return DualReport(
            figures.select("tasks", F.col("task_stories").alias("stories")),
            figures.select("stories", "wins_a", "wins_b", "wins_a_pct", "wins_b_pct", "mean_a", "mean_b"),
            report.to_long(figures, (), named),
            figures.select(*[c for c in figures.columns if c.startswith("mean_") and c.endswith("_time") or "_time_" in c]),
        )

    def write(self, folder: str, timestamp: str | None = None, fmt: str = "csv") -> tuple[str, str]:
        """The task table and the judge results, under names of this run."""
        suffix = ".csv" if fmt == "csv" else ""
        path = writers.run_path(folder, "dual_tasks", suffix, timestamp)
        stem = path.rsplit("/", 1)[1].removesuffix(suffix)
        return (
            writers.write_tasks(self.tasks, path, fmt),
            writers.write_judge_results(self.judged, folder, stem, fmt),
        )

    def judge_results(self) -> DataFrame:
        """The columns of a judge-result file."""
        return self.judged.select(*JUDGE_RESULT_COLUMNS)


def run_dual(
    df: DataFrame,
    call_a: inference.ModelCall,
    call_b: inference.ModelCall,
    judge_call: inference.ModelCall,
    order_by: Sequence[ColumnOrName],
    story: str = "input",
    sample_size: int | None = None,
    partitions: int | None = None,
    prompt: ColumnOrName | None = None,
    judge_prompt: ColumnOrName | None = None,
    case_sensitive: bool = False,
    zero_retries: int = judging.ZERO_RETRIES,
) -> DualResult:
    """Both generators answer every valid story, the judge compares, tasks are paired.

    The generators run side by side in one pass and add to the same row, so
    neither their replies nor the task lists need a join.  Calls without options
    take the defaults of this job: 0.3, 0.7 for the second generator, 0.2 for the
    judge.
    """
    if call_b.options is None:
        call_b = replace(call_b, options=SECOND_OPTIONS)
    if judge_call.options is None:
        judge_call = replace(judge_call, options=JUDGE_OPTIONS)
    start = datetime.now()
    cleaned = columns.clean_text_rows(df, story, sample_size, order_by)
    valid = stories.valid_stories(cleaned, story, case_sensitive)
    numbered = ids.dense_id(valid, order_by, "us_id", partitions=partitions)
    prompt = task_prompt(story) if prompt is None else prompt
    answered = inference.generate_all(
        numbered,
        [
            inference.Ask(prompt, "tasks_generator_a", call_a, "generation_time_a"),
            inference.Ask(prompt, "tasks_generator_b", call_b, "generation_time_b"),
        ],
        partitions,
    )
    judged = judging.judge_pairs(
        answered,
        story,
        "tasks_generator_a",
        "tasks_generator_b",
        judge_call,
        prompt=judge_prompt,
        zero_retries=zero_retries,
        partitions=partitions,
    )
    timed = columns.add_total_time(
        judged, ["generation_time_a", "generation_time_b", "judge_time"]
    )
    stamped = columns.add_run_times(timed, start, datetime.now())
    return DualResult(tasks.compare_tasks(stamped, carry=[story]), stamped)
