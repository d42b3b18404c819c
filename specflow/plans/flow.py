"""Named steps chained into one lazy plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from specflow.functions.common import require_columns


@dataclass(frozen=True)
class Step:
    """A ``DataFrame -> DataFrame`` function with a name, needed columns and renames."""

    name: str
    run: Callable[..., DataFrame]
    inputs: Sequence[str] = ()
    rename_in: Mapping[str, str] = field(default_factory=dict)
    rename_out: Mapping[str, str] = field(default_factory=dict)

    def __call__(self, df: DataFrame | None = None) -> DataFrame:
        if df is None:
            df = self.run()
        else:
            df = df.withColumnsRenamed(dict(self.rename_in))
            require_columns(df, self.inputs, f"step '{self.name}'")
            df = self.run(df)
        return df.withColumnsRenamed(dict(self.rename_out)) if self.rename_out else df


class Flow:
    """Steps run in order.  ``flow >> step`` and ``flow.add(step)`` are the same.

    Without an input table the first step is the source and takes no argument.
    After ``run`` the (lazy) table after each step is in ``outputs``.
    """

    def __init__(self, name: str, description: str = ""):
        self.name = name
        self.description = description
        self.steps: list[Step] = []
        self.outputs: dict[str, DataFrame] = {}

    def add(self, step: Step | Callable) -> Flow:
        if not isinstance(step, Step):
            step = Step(getattr(step, "__name__", f"step{len(self.steps) + 1}"), step)
        self.steps.append(step)
        return self

    __rshift__ = add

    def run(self, df: DataFrame | None = None) -> DataFrame:
        if not self.steps:
            raise ValueError(f"flow '{self.name}' has no steps")
        self.outputs = {}
        for step in self.steps:
            try:
                df = step(df)
            except Exception as error:
                error.add_note(f"in step '{step.name}' of flow '{self.name}'")
                raise
            self.outputs[step.name] = df
        return df
