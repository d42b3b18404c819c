"""Judge answers or result files -> summaries.  No model involved."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from specflow.operators import judging, report
from specflow.session import materialize
from specflow.sources.readers import read_judge_results
from specflow.sources.writers import write_summary


@dataclass(frozen=True)
class Summaries:
    """Reports over judge results; the spread of the totals is worked out when first asked for.

    ``consolidated`` is written when a summary is first asked for, a few rows per file, so
    the results are read once for all summaries.
    """

    consolidated: DataFrame
    results: DataFrame

    @cached_property
    def _stored(self) -> DataFrame:
        return materialize(self.consolidated, "consolidated")

    @cached_property
    def criteria(self) -> DataFrame:
        return report.criterion_summary(self._stored)

    @cached_property
    def metrics(self) -> DataFrame:
        return report.aggregate_summary(self._stored)

    @cached_property
    def boxes(self) -> DataFrame:
        return report.box_stats(self.results, ["Config"])

    @cached_property
    def outliers(self) -> DataFrame:
        return report.outliers(self.results, ["Config"])

    def write(self, folder: str, mode: str = "error") -> None:
        write_summary(self.criteria, f"{folder}/criterion_summary.csv", mode)
        write_summary(self.metrics, f"{folder}/aggregate_summary.csv", mode)


def evaluate_answers(df: DataFrame, raw_column: str, config: str = "Config") -> DataFrame:
    """Raw pair-judge answers -> criterion means and metrics per configuration and generator."""
    return report.consolidate(judging.parse_pair_judgement(df, raw_column), config)


def evaluate_files(
    spark: SparkSession,
    folder: str,
    threshold: float = judging.THRESHOLD,
    numbered: bool = False,
    fmt: str = "csv",
    multi_line: bool = True,
) -> Summaries:
    """Every result file of a folder -> the two summaries, two rows per file, and the spread of the totals."""
    results = read_judge_results(spark, folder, numbered=numbered, fmt=fmt, multi_line=multi_line)
    long = report.consolidate(results, threshold=threshold, by=["test"])
    return Summaries(long, results)
