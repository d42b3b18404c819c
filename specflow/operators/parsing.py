"""Free-text answers -> JSON fields, table by table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.functions import jsontext as J
from specflow.functions.common import require_columns, settle

_STEPS = ("__text", "__cut", "__clean", "__direct", "__other", "__mended", "__lax", "__lax_other")


def parse_json(
    df: DataFrame, raw_column: str, fields: str = "fields", status: str = "parse_status"
) -> DataFrame:
    """Add the top-level fields of the JSON answer and how they were obtained.

    ``status`` is ``direct``, ``repaired`` or ``failed``.  ``fields`` is a map of
    texts, null unless the answer is an object.  The repair runs only for the
    rows the strict parse refuses.
    """
    require_columns(df, [raw_column], "parse_json")
    text, cut, clean, direct, other, mended, lax, lax_other = (F.col(c) for c in _STEPS)
    staged = (
        df.withColumn("__text", J.unfenced(F.coalesce(F.col(raw_column), F.lit(""))))
        .withColumn("__cut", J.from_braces(text))
        .withColumn("__clean", F.when(cut != "", cut).otherwise(text))
    )
    staged = J.with_json_object(staged, "__clean", "__direct")
    staged = J.with_other_json(staged, "__clean", "__other", direct.isNull())
    ok = direct.isNotNull() | other
    staged = staged.withColumn("__mended", F.when(~ok, J.repair_json(clean)))
    staged = J.with_json_object(staged, "__mended", "__lax", lax=True)
    staged = J.with_other_json(staged, "__mended", "__lax_other", lax.isNull(), lax=True)
    how = (
        F.when(ok, F.lit("direct"))
        .when(lax.isNotNull() | lax_other, F.lit("repaired"))
        .otherwise(F.lit("failed"))
    )
    parsed = staged.withColumns({fields: F.coalesce(direct, lax), status: how})
    return settle(parsed.drop(*_STEPS), [fields, status])


def parse_metrics(df: DataFrame, status: str = "parse_status") -> DataFrame:
    """One row: how many answers parsed directly, after repair, or not at all, and in percent."""
    require_columns(df, [status], "parse_metrics")
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(status) == "direct").alias("success"),
        F.count_if(F.col(status) == "repaired").alias("repaired"),
        F.count_if(F.col(status) == "failed").alias("failed"),
    )
    shares = {
        f"{c}_pct": F.try_divide(F.col(c) * F.lit(100.0), F.col("total"))
        for c in ("success", "repaired", "failed")
    }
    return counts.withColumns(shares)


def normalize_keys(
    df: DataFrame, fields: str, expected: Sequence[str], threshold: int = 2, out: str | None = None
) -> DataFrame:
    """Rename keys fewer than ``threshold`` edits from an expected one; others stay."""
    require_columns(df, [fields], "normalize_keys")
    staged = df.withColumn("__entries", J.named_entries(fields, expected, threshold))
    return staged.withColumn(out or fields, J.rename_keys("__entries", expected)).drop("__entries")
