"""Small helpers of the operators, most for code that runs inside Python workers."""

from __future__ import annotations

import sys
import types

import pyarrow as pa
from pyspark.sql import DataFrame


def kept(name: str, make):
    """A value that lives as long as the worker process, shared by its tasks.

    Functions arrive with each task, so a module global would be new each time.
    """
    home = sys.modules.setdefault("_specflow_worker", types.ModuleType("_specflow_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def bounded_slices(texts: pa.Array, limit: int = 1_000_000):
    """(from, to) of runs of rows holding about ``limit`` bytes of text; a longer text is alone."""
    size, start = 0, 0
    for i, text in enumerate(texts):
        n = len(text.as_buffer()) if text.is_valid else 0
        if size and size + n > limit:
            yield start, i
            size, start = 0, i
        size += n
    if start < len(texts):
        yield start, len(texts)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until ``df`` has no column called so, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
