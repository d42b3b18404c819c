"""Projection, filters and row construction."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from specflow.functions.common import ColumnOrName, as_col, require_columns
from specflow.functions.numbers import to_number
from specflow.functions.text import strip

CRITERIA = ("coherence", "completeness", "feasibility", "format", "granularity")


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns, in this order."""
    require_columns(df, columns, "keep_columns")
    return df.select(*columns)


def add_column(
    df: DataFrame,
    name: str,
    func: Callable | Column,
    inputs: Sequence[str] = (),
    returns: str | None = None,
    vectorized: bool = False,
) -> DataFrame:
    """Add (or overwrite) one column.

    ``func`` is a Column, or a function of Columns, and stays inside the JVM.
    Only with ``returns`` is it a Python function of plain values; it then runs
    over Arrow batches and needs its result type named.  With ``vectorized`` it
    takes and gives a pandas Series per batch.
    """
    require_columns(df, inputs, f"add_column({name})")
    if isinstance(func, Column):
        return df.withColumn(name, func)
    if returns is None:
        value = func(*[F.col(c) for c in inputs])
        return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))

    @F.pandas_udf(returns)
    def by_batch(*series: pd.Series) -> pd.Series:
        return func(*series) if vectorized else pd.Series([func(*row) for row in zip(*series, strict=True)])

    @F.pandas_udf(returns)
    def without_input(seed: pd.Series) -> pd.Series:
        return pd.Series([func() for _ in range(len(seed))])

    value = by_batch(*[F.col(c) for c in inputs]) if inputs else without_input(F.lit(0))
    return df.withColumn(name, value)


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def move_first(df: DataFrame, column: str) -> DataFrame:
    require_columns(df, [column], "move_first")
    return df.select(column, *[c for c in df.columns if c != column])


def drop_missing(
    df: DataFrame, columns: Sequence[str], observation: Observation | None = None
) -> DataFrame:
    """Rows in which none of ``columns`` is null.

    With an ``observation``, the rows seen and the rows dropped are counted in
    the same pass as ``rows`` and ``dropped``.
    """
    require_columns(df, columns, "drop_missing")
    if observation is not None:
        missing = F.lit(False)
        for name in columns:
            missing = missing | F.col(name).isNull()
        df = df.observe(
            observation, F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("dropped")
        )
    return df.dropna(subset=list(columns))


def clean_text_rows(
    df: DataFrame,
    column: str = "input",
    sample_size: int | None = None,
    order_by: Sequence[ColumnOrName] = (),
    observation: Observation | None = None,
) -> DataFrame:
    """Drop null and blank texts and strip the rest; an optional first-N comes before that."""
    require_columns(df, [column], "clean_text_rows")
    if sample_size is not None:
        if sample_size <= 0:
            raise ValueError(f"sample_size must be positive, got {sample_size}")
        if not order_by:
            raise ValueError("sample_size needs order_by: rows have no order of their own")
        df = df.orderBy(*order_by).limit(sample_size)
    text = strip(F.col(column).cast("string"))
    if observation is not None:
        unusable = F.coalesce(text == "", F.lit(True))
        df = df.observe(
            observation, F.count(F.lit(1)).alias("rows"), F.count_if(unusable).alias("dropped")
        )
    return df.withColumn(column, text).filter(F.col(column) != "")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The table itself, or an error when it has no rows (looks at one row only)."""
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Score columns as doubles, unusable values null; other columns are left alone."""
    return df.withColumns({c: to_number(c) for c in columns if c in df.columns})


def recompute_totals(
    df: DataFrame, prefix: str = "judge_score_", criteria: Sequence[str] = CRITERIA
) -> DataFrame:
    """Overwrite both totals with the sum of their criteria; nulls count as nothing."""
    names = [f"{prefix}{side}_{c}" for side in "ab" for c in criteria]
    require_columns(df, names, "recompute_totals")
    totals = {}
    for side in "ab":
        total = F.lit(0)
        for c in criteria:
            total = total + F.coalesce(F.col(f"{prefix}{side}_{c}"), F.lit(0))
        totals[f"{prefix}{side}_total"] = total
    return df.withColumns(totals)


def add_total_time(df: DataFrame, columns: Sequence[str], name: str = "total_time") -> DataFrame:
    """Sum of the step seconds of a row; null when one is missing."""
    require_columns(df, columns, "add_total_time")
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return df.withColumn(name, total)


def add_run_times(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """The run's start and end, the same on every row."""
    return df.withColumns({"start_timestamp": F.lit(start), "end_timestamp": F.lit(end)})


def chosen(winner: ColumnOrName, text_a: ColumnOrName, text_b: ColumnOrName) -> Column:
    """B's text where B won, else A's."""
    return F.when(as_col(winner) == "B", as_col(text_b)).otherwise(as_col(text_a))


# --- fixed values -----------------------------------------------------------
# smallest and largest value of each setting; None: no end
SETTING_RANGES = {
    "batch_size": (1, None),
    "temperature": (0.0, 2.0),
    "max_tokens": (1, None),
    "workers": (1, None),
    "threshold": (0.0, 50.0),
}
# ----------------------------------------------------------------------------


def setting_problems(settings: Mapping[str, ColumnOrName]) -> Column:
    """Names of the settings of a row that are outside their range, in the order given.

    For tables of planned runs, one setting a column: ``{"temperature": "temp", ...}``.
    A null setting is one that is not given, and no problem; not-a-number is one.
    """
    unknown = [name for name in settings if name not in SETTING_RANGES]
    if unknown:
        raise ValueError(f"no such settings: {unknown}; known: {list(SETTING_RANGES)}")
    found = []
    for name, column in settings.items():
        value, (least, most) = as_col(column).cast("double"), SETTING_RANGES[name]
        wrong = (value < least) | F.isnan(value)
        if most is not None:
            wrong = wrong | (value > most)
        found.append(F.when(wrong, F.lit(name)))
    return F.array_compact(F.array(*found))


def refuse_settings(df: DataFrame, settings: Mapping[str, ColumnOrName]) -> DataFrame:
    """The rows themselves; reading one whose settings are outside their range fails with their names."""
    problems = setting_problems(settings)
    message = F.concat(F.lit("settings out of range: "), F.array_join(problems, ", "))
    return df.filter(F.when(F.size(problems) == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def check_settings(
    *,
    batch_size: int | None = None,
    temperature: float | None = None,
    max_tokens: int | None = None,
    workers: int | None = None,
    threshold: float | None = None,
) -> None:
    """Refuse settings outside their range before anything runs."""
    given = dict(batch_size=batch_size, temperature=temperature, max_tokens=max_tokens, workers=workers, threshold=threshold)
    for name, value in given.items():
        if value is None:
            continue
        least, most = SETTING_RANGES[name]
        if not (value >= least and (most is None or value <= most)):
            span = f"at least {least}" if most is None else f"between {least:g} and {most:g}"
            raise ValueError(f"{name} must be {span}, got {value}")
