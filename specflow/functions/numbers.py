"""Numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from specflow.functions.common import ColumnOrName, as_col
from specflow.functions.text import strip

# the JVM also reads "7d", "0x1p3" and "NaN" as numbers; a decimal has only these
# characters, and blanks around them, of which the cast itself drops the ASCII ones
_NOT_DECIMAL = r"[^0-9eE+.\- \t-\r\x1c-\x1f]"
_WIDE_BLANK = r"[\x85\p{Z}&&[^ ]]"


def to_number(text: ColumnOrName) -> Column:
    """Double written in decimal digits, null for anything else."""
    text = as_col(text).cast("string")
    bare = strip(text)
    wide = text.rlike(_WIDE_BLANK) & ~bare.rlike(_NOT_DECIMAL)
    return F.when(~text.rlike(_NOT_DECIMAL), text.try_cast("double")).when(
        wide, bare.try_cast("double")
    )


def clamped_score(number: ColumnOrName) -> Column:
    """Whole score from 0 to 10: fraction cut off, out of range clamped, unusable 0."""
    number = as_col(number)
    limited = F.greatest(F.lit(0.0), F.least(F.lit(10.0), number)).cast("int")
    return F.when(F.abs(number) < float("inf"), limited).otherwise(F.lit(0))
