"""Prompt texts as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from specflow.functions.common import ColumnOrName, as_col
from specflow.functions.text import strip

_PLACEHOLDER = re.compile(r"\{\{(.+?)\}\}")

TASK_TEMPLATE = """Split the user story below into separate development tasks. Use as many tasks as the story needs; \
no two tasks may overlap and each must be something a developer can start on.

Answer in plain text, one numbered task after the other, in this layout:

1. summary: short title of the first task
description: what has to be done

2. summary: short title of the second task
description: what has to be done

`summary:` and `description:` each begin a line of their own. No bold, italics or code marks.

User story:
{{user_story}}"""

JUDGE_TEMPLATE = """Review whether the tasks below are a correct and complete breakdown of the user story.

User story:
{{story}}

Tasks:
{{tasks}}

Give 0 to 10 points for each of: coherence (tasks belong to the story), completeness (nothing needed is missing), \
feasibility (tasks can be built), format (title, description, clear structure), granularity (tasks neither too large \
nor too small). Set "aprobado" to false below {{threshold}} of 50 points, when a critical part of the format is \
missing, or when tasks are off topic.

Answer with one JSON object only, of this shape:
{"coherence": {"puntuacion": 7, "justificacion": "..."}, "completeness": {"puntuacion": 7, "justificacion": "...", \
"tareas_faltantes": []}, "feasibility": {"puntuacion": 7, "justificacion": "..."}, "format": {"puntuacion": 7, \
"justificacion": "..."}, "granularity": {"puntuacion": 7, "justificacion": "..."}, "puntuacion_total": 35, \
"aprobado": true, "problemas_criticos": [], "recomendaciones": []}"""

PAIR_TEMPLATE = """Two breakdowns of one user story are given. Score both and name the better one.

User story:
{{user_story}}

Breakdown A:
{{tasks_a}}

Breakdown B:
{{tasks_b}}

Criteria, 1 to 10 points each: coherence with the story, completeness of coverage, feasibility of the tasks, \
format and clarity, granularity of the split.

Answer with one JSON object with exactly these keys: "coherence_a", "completeness_a", "feasibility_a", "format_a", \
"granularity_a", "coherence_b", "completeness_b", "feasibility_b", "format_b", "granularity_b" (integers), \
"winner" ("A" or "B") and "reason" (one sentence)."""


def render(template: str, values: Mapping[str, ColumnOrName]) -> Column:
    """Fill ``{{ name }}`` places of ``template`` from columns, in one pass.

    Unknown names stay as they are, values are not expanded again, and a null
    value renders as an empty text.
    """
    parts: list[Column] = []
    end = 0
    for match in _PLACEHOLDER.finditer(template):
        value = values.get(match.group(1).strip())
        if value is None:
            continue
        parts.append(F.lit(template[end : match.start()]))
        parts.append(F.coalesce(as_col(value).cast("string"), F.lit("")))
        end = match.end()
    parts.append(F.lit(template[end:]))
    return F.concat(*parts)


def task_prompt(story: ColumnOrName, template: str = TASK_TEMPLATE) -> Column:
    return render(template, {"user_story": strip(story)})


def judge_prompt(
    story: ColumnOrName, tasks: ColumnOrName, threshold: float = 35.0, template: str = JUDGE_TEMPLATE
) -> Column:
    return render(template, {"story": story, "tasks": tasks, "threshold": F.lit(str(threshold))})


def pair_prompt(
    story: ColumnOrName, tasks_a: ColumnOrName, tasks_b: ColumnOrName, template: str = PAIR_TEMPLATE
) -> Column:
    values = {"user_story": strip(story), "tasks_a": strip(tasks_a), "tasks_b": strip(tasks_b)}
    return render(template, values)


def retry_note(attempt: int) -> str:
    return (
        f"\n\nRETRY {attempt}: your last answer scored at least one criterion 0. "
        "A score of 0 is not allowed; give every criterion 1 to 10."
    )


def stricter(prompt: ColumnOrName, attempt: int) -> Column:
    """The prompt for re-ask number ``attempt`` after an answer that held a zero score."""
    if attempt == 0:
        return as_col(prompt)
    return F.concat(as_col(prompt), F.lit(retry_note(attempt)))
