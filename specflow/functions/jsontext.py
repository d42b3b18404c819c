"""JSON objects inside free text, read with Spark's own parser.

``from_json`` stops at the end of the first value and ignores what follows.
To refuse trailing text, the candidate is parsed as the first element of an
array whose second element is a fixed end mark: anything that closes the value
early, or adds another one, loses the mark or changes the length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specflow.functions.common import ColumnOrName, as_col
from specflow.functions.text import DIGIT, WS, strip

# --- fixed values -----------------------------------------------------------
_STRICT = {"allowSingleQuotes": "false"}
_LAX = {"allowSingleQuotes": "false", "allowUnquotedControlChars": "true"}
_END_KEY = "specflow-end"
_WORD = r"[\p{L}\p{N}_]"
_NEXT_KEY = rf'(?="{_WORD}+":)'
# how a JSON value other than an object begins
_OTHER_VALUE = r'^[ \t\n\r]*(?:[\["0-9-]|true|false|null|NaN|Infinity)'
# control characters no repair covers: all but NUL, tab, newline and return
_BAD_CONTROL = r"[\x01-\x08\x0b\x0c\x0e-\x1f]"
# ----------------------------------------------------------------------------


def from_braces(text: ColumnOrName) -> Column:
    """From the first ``{`` to the last ``}``, empty when there is no such span."""
    return F.regexp_extract(as_col(text), r"(?s)\A[^{]*+(\{.*\})", 1)


def unfenced(raw: ColumnOrName) -> Column:
    """Answer without code fences and outer blanks."""
    return strip(F.replace(F.replace(as_col(raw), F.lit("```json")), F.lit("```")))


def clean_json(raw: ColumnOrName) -> Column:
    """Answer without code fences, cut to its outermost braces when it has them."""
    raw = as_col(raw)
    cut = F.nullif(from_braces(unfenced(raw)), F.lit(""))
    return (
        F.when(raw.isNull(), F.lit(""))
        .when(strip(raw) == "", raw)
        .otherwise(F.coalesce(cut, unfenced(raw)))
    )


def is_truncated(cleaned: ColumnOrName) -> Column:
    """More opening than closing braces."""
    cleaned = as_col(cleaned)
    return F.regexp_count(cleaned, F.lit(r"\{")) > F.regexp_count(cleaned, F.lit(r"\}"))


def repair_json(cleaned: ColumnOrName) -> Column:
    """Mend missing and trailing commas and drop NUL characters.

    Raw newlines, returns and tabs inside strings are left for the lax parser.
    """
    text = F.regexp_replace(as_col(cleaned), r"\x00", "")
    text = F.regexp_replace(text, rf"(?<=[{DIGIT}}}\]]){WS}*{_NEXT_KEY}", ", ")
    text = F.regexp_replace(text, rf'"{WS}*\n{WS}*{_NEXT_KEY}', '",\n')
    return F.regexp_replace(text, rf",{WS}*(?=[}}\]])", "")


def with_json_object(df: DataFrame, text: str, out: str, lax: bool = False) -> DataFrame:
    """Add a JSON object's top level as ``map<string,string>``; null if ``text`` is anything else.

    The parsed value is used several times below and parsing is the costly
    part, so it is a column of its own.
    """
    mode = _LAX if lax else _STRICT
    values = F.from_json(_with_end(text), "array<map<string,string>>", mode)
    staged = df.withColumn("__values", F.when(_plain(text, lax), values))
    value = F.col("__values")
    complete = (F.size(value) == 2) & (F.get(value, F.lit(1))[_END_KEY] == "1")
    staged = staged.withColumn("__first", F.when(complete, F.get(value, F.lit(0)))).drop("__values")
    return staged.withColumn(out, last_wins("__first")).drop("__first")


def last_wins(fields: ColumnOrName) -> Column:
    """The map with every key once, where it first stood, with the value it was given last.

    ``from_json`` keeps repeated keys in a map; a lookup would take the first.
    """
    fields = as_col(fields)
    keys = F.map_keys(fields)
    once = F.array_distinct(keys)

    def last(key: Column) -> Column:
        same = F.filter(F.map_entries(fields), lambda e: e["key"] == key)
        return F.element_at(same, F.lit(-1))["value"]

    return F.when(F.size(keys) == F.size(once), fields).otherwise(F.map_from_arrays(once, F.transform(once, last)))


def with_other_json(
    df: DataFrame, text: str, out: str, needed: Column, lax: bool = False
) -> DataFrame:
    """Add whether ``text`` is a JSON value other than an object; false where not ``needed``."""
    mode = _LAX if lax else _STRICT
    values = F.from_json(_with_end(text), "array<string>", mode)
    candidate = needed & _plain(text, lax) & as_col(text).rlike(_OTHER_VALUE)
    staged = df.withColumn("__values", F.when(candidate, values))
    value = F.col("__values")
    complete = (F.size(value) == 2) & (F.get(value, F.lit(1)) == f'{{"{_END_KEY}":"1"}}')
    return staged.withColumn(out, F.coalesce(complete, F.lit(False))).drop("__values")


def nearest_key(key: ColumnOrName, expected: Sequence[str], threshold: int = 2) -> Column:
    """The expected key fewer than ``threshold`` edits away; ties go to the earlier one."""
    key = as_col(key)
    expected = list(expected)
    scored = F.array(
        *[
            F.struct(
                F.levenshtein(key, F.lit(name), threshold - 1).alias("edits"),
                F.lit(place).alias("place"),
                F.lit(name).alias("name"),
            )
            for place, name in enumerate(expected)
        ]
    )
    nearest = F.array_min(F.filter(scored, lambda s: s["edits"] >= 0))["name"]
    return F.when(key.isin(expected), key).otherwise(nearest)


def named_entries(fields: ColumnOrName, expected: Sequence[str], threshold: int = 2) -> Column:
    """Entries of a map as ``(key, value, name)`` with the expected key each one means."""
    return F.transform(
        F.map_entries(as_col(fields)),
        lambda e: F.struct(
            e["key"].alias("key"),
            e["value"].alias("value"),
            nearest_key(e["key"], expected, threshold).alias("name"),
        ),
    )


def last_value(entries: ColumnOrName, name: str) -> Column:
    """Value of the last entry that means ``name``."""
    same = F.filter(as_col(entries), lambda e: e["name"] == name)
    return F.try_element_at(same, F.lit(-1))["value"]


def rename_keys(entries: ColumnOrName, expected: Sequence[str]) -> Column:
    """Map with close keys renamed; for two that mean the same the later one wins."""
    entries = as_col(entries)
    others = F.filter(entries, lambda e: e["name"].isNull())
    plain = F.map_from_arrays(
        F.transform(others, lambda e: e["key"]), F.transform(others, lambda e: e["value"])
    )
    present = F.filter(
        F.array(*[F.lit(name) for name in expected]),
        lambda name: F.exists(entries, lambda e: e["name"] == name),
    )
    renamed = F.map_from_arrays(
        present,
        F.transform(
            present,
            lambda name: F.element_at(F.filter(entries, lambda e: e["name"] == name), F.lit(-1))["value"],
        ),
    )
    return F.map_concat(plain, renamed)


def _with_end(text: ColumnOrName) -> Column:
    return F.concat(F.lit("["), as_col(text), F.lit(f',{{"{_END_KEY}":"1"}}]'))


def _plain(text: ColumnOrName, lax: bool) -> Column:
    text = as_col(text)
    return text.isNotNull() & ~text.rlike(_BAD_CONTROL) if lax else text.isNotNull()
