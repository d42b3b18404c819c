"""Small shared helpers for Column arguments and eager checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_list(value) -> list:
    return [value] if isinstance(value, (str, Column)) else list(value or [])


def require_columns(df: DataFrame, names: Iterable[str], who: str = "operator") -> None:
    """Fail on the driver, before any job, when a needed column is missing."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{who}: missing columns {missing}; available: {df.columns}")


def settle(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Pin costly computed columns, so that they are evaluated once per row.

    A filter on a computed column is pushed below the projection that computes
    it, which repeats the whole expression (for a parsed score, the parsing) in
    the filter, once per use.  Filters do not move below a generator on its own
    output, so the columns are passed through one that yields exactly one row.
    """
    columns = list(columns)
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[F.col(c).alias(c) for c in columns])
    return df.select(*kept, F.inline_outer(F.array(row))).select(*df.columns)
