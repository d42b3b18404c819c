"""Text expressions: whitespace, the story format and numbered answers.

The patterns spell out their character classes instead of relying on regex
flags: ``WS`` is every character Unicode counts as blank plus the four
information separators, ``DIGIT`` any decimal digit of any script.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from specflow.functions.common import ColumnOrName, as_col

# --- fixed values -----------------------------------------------------------
WS = r"[\t-\r\x1c-\x1f \x85\p{Z}]"
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
DIGIT = r"\p{Nd}"

# "As a ROLE, I want FEATURE so that BENEFIT" on text whose blanks are already
# single spaces.  The atomic groups stop at the first ", I want " and at the
# first " so that " after it, so a non-matching text is scanned only once.
STORY = r"^As an? (?>.+?, I want )(?>.+? so that )."

# "1." "1)" "a." "a)", an optional "(label)", then a possibly bold "summary:"
_MARKER = rf"(?:{DIGIT}+|[a-z])[.)]"
_NOTE = rf"(?:\([^)]*\){WS}*)?"
_SUMMARY = rf"\*{{0,2}}[Ss]ummary{WS}*\*{{0,2}}{WS}*:"

# A break begins at the first newline of a run of blanks that ends at a task and
# takes the rest of the run.  Blanks before that newline stay with the piece.
_LINE = r"\n(?<!\n\n)"

NUMBERED_BREAK = rf"{_LINE}{WS}*+(?={_MARKER}{WS}*{_NOTE}{_SUMMARY})"
NUMBERED_START = rf"(?iu)^{WS}*(?:{_MARKER})?{WS}*{_NOTE}{_SUMMARY}"
LABEL_BREAK = rf"\n(?={_SUMMARY})"
LABEL_START = rf"^{_SUMMARY}"
LETTERED_BREAK = rf"{_LINE}{WS}*+(?=[a-z]\){WS}+{DIGIT}+\.{DIGIT}+\.{WS}+)"
LETTERED_START = rf"^(?:[a-z]\)|[Ss]ummary{WS}*:)"

# Prefixes removed from a task, one after the other: "12. " "12) " "a) " "a. " "4.1 "
TASK_PREFIXES = (
    rf"^{DIGIT}+\.{WS}+",
    rf"^{DIGIT}+\){WS}+",
    rf"^[a-z]\){WS}+",
    rf"^[a-z]\.{WS}+",
    rf"^{DIGIT}+\.{DIGIT}+(?:\.{DIGIT}+)*{WS}+",
)
# With strict numbering "4.1. " goes too, and "8.summary:" loses its "8."
STRICT_PREFIXES = (
    rf"^{DIGIT}+\.{DIGIT}+(?:\.{DIGIT}+)*\.?{WS}+",
    rf"^(?:{DIGIT}+|[a-z])[.)](?=\*{{0,2}}[Ss]ummary)",
)
BOLD_LABELS = ("[Ss]ummary", "[Dd]escription")

# A code point Unicode reserves for internal use; marks the places to cut.
CUT = "\ufdd0"
# ----------------------------------------------------------------------------


def strip(text: ColumnOrName) -> Column:
    """Remove leading and trailing blanks of every kind (``trim`` knows only the space)."""
    return F.btrim(as_col(text), F.lit(BLANKS))


def squeeze(text: ColumnOrName) -> Column:
    """Text with every run of blanks turned into one space, none at the ends."""
    return F.trim(F.regexp_replace(as_col(text).cast("string"), rf"{WS}+", " "))


def is_story(text: ColumnOrName, case_sensitive: bool = False) -> Column:
    """Whether the text reads "As a ROLE, I want FEATURE so that BENEFIT"; null is false."""
    pattern = STORY if case_sensitive else f"(?iu){STORY}"
    return F.coalesce(squeeze(text).rlike(pattern), F.lit(False))


def cut_before(stripped: ColumnOrName, line_break: str) -> Column:
    """Pieces of a stripped text, cut where ``line_break`` matches; ends are not stripped.

    Spark compiles the pattern of ``split`` for every row but keeps the one of
    ``regexp_replace``, so the breaks are first turned into a reserved character.
    A text that already holds that character is split directly.
    """
    text = as_col(stripped)
    marked = F.split(F.regexp_replace(text, line_break, CUT), CUT, -1)
    return (
        F.when(text == "", F.array().cast("array<string>"))
        .when(F.contains(text, F.lit(CUT)), F.split(text, line_break, -1))
        .otherwise(marked)
    )


def without_preamble(pieces: ColumnOrName, start: str) -> Column:
    """Drop the first piece unless it begins the way a task does."""
    pieces = as_col(pieces)
    keep = (F.size(pieces) == 0) | F.get(pieces, F.lit(0)).rlike(start)
    return F.when(keep, pieces).otherwise(F.slice(pieces, F.lit(2), F.size(pieces)))


def without_marker(task: ColumnOrName, strict_numbers: bool = False) -> Column:
    """Stripped task text without its list marker."""
    task = strip(task)
    for prefix in TASK_PREFIXES + (STRICT_PREFIXES if strict_numbers else ()):
        task = F.regexp_replace(task, prefix, "")
    return task


def without_bold(task: ColumnOrName) -> Column:
    """Text without bold marks around its labels and at its line ends."""
    plain = task = as_col(task)
    for label in BOLD_LABELS:
        task = F.regexp_replace(task, rf"\*\*({label})\*\*{WS}*:", "$1:")
        task = F.regexp_replace(task, rf"\*\*({label}){WS}*:{WS}*\*\*", "$1:")
        task = F.regexp_replace(task, rf"\*\*({label}){WS}*:", "$1:")
    task = F.regexp_replace(task, rf"\*\*{WS}*(?=\n|\z)", "")
    return F.when(F.contains(plain, F.lit("**")), task).otherwise(plain)


def clean_task(task: ColumnOrName, strict_numbers: bool = False) -> Column:
    """Task text without its list marker and without bold marks on its labels."""
    return without_bold(without_marker(task, strict_numbers))


def task_summary(task: ColumnOrName) -> Column:
    """Text after the ``summary:`` label up to the ``description:`` label, null if absent."""
    found = F.regexp_extract(
        as_col(task), rf"(?is)summary{WS}*:(.*?)(?:\n{WS}*description{WS}*:|\z)", 1
    )
    return F.nullif(strip(found), F.lit(""))


def task_description(task: ColumnOrName) -> Column:
    """Text after the ``description:`` label that starts a line, null if absent."""
    found = F.regexp_extract(as_col(task), rf"(?is)(?:\A|\n){WS}*description{WS}*:(.*)\z", 1)
    return F.nullif(strip(found), F.lit(""))
