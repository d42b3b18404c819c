"""Line de-duplication over overlapping three-line windows, native throughout.

Every run of three consecutive lines is hashed (128 bits).  The first place of a
window in the corpus, by (doc_id, hash of the text, line), is kept; every later
place covers its three lines, covered positions of a document are merged and
those lines go.  The first copy of each line always stays somewhere: a later
place repeats lines that stand earlier.

Lines are compared as they are, split at line feeds.  Windows of blank lines
only never count.  Documents of fewer than three lines have no window and stay.

Null text: stays null.  Null doc_id: sorts first.  Rows equal in doc_id and text
are one document and are treated alike.  Empty table: empty result.  Other
columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specflow.llm.worker import unused
from specflow.session import materialize

_KEY = ["__doc", "__tie"]


def _split(text: Column | str) -> Column:
    return F.split(text, "\n", -1)


def line_windows(docs: DataFrame, *, lines: int = 3) -> DataFrame:
    """__doc, __tie, __pos, __h1, __h2 per window of ``docs``."""
    line = F.transform(
        _split("text"),
        lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), x.rlike(r"\S").alias("s")),
    )
    keyed = docs.select(F.col("doc_id").cast("long").alias("__doc"), F.xxhash64("text").alias("__tie"), line.alias("__line"))
    n = F.greatest(F.lit(0), F.size("__line") - (lines - 1))
    shifted = [F.slice("__line", k + 1, n) for k in range(lines)]
    runs = F.arrays_zip(*[s.alias(f"l{k}") for k, s in enumerate(shifted)])

    def part(z: Column, name: str) -> list[Column]:
        return [z[f"l{k}"][name] for k in range(lines)]

    def window(z: Column) -> Column:
        some = part(z, "s")[0]
        for s in part(z, "s")[1:]:
            some = some | s
        return F.struct(F.xxhash64(*part(z, "a")).alias("h1"), F.xxhash64(*part(z, "b")).alias("h2"), some.alias("s"))

    rows = keyed.select(*_KEY, F.posexplode(F.transform(runs, window)).alias("__pos", "w")).where("w.s")
    return rows.select(*_KEY, "__pos", F.col("w.h1").alias("__h1"), F.col("w.h2").alias("__h2"))


def drop_repeated_windows(docs: DataFrame, *, lines: int = 3, counts: bool = False) -> DataFrame:
    """``docs`` with later copies of line windows cut out of ``text``; with ``counts`` also n_lines and n_removed."""
    windows = line_windows(docs, lines=lines)
    place = F.struct("__doc", "__tie", "__pos")
    repeated = windows.groupBy("__h1", "__h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = materialize(repeated.where("n > 1").select("__h1", "__h2", "first"), "repeated-windows")
    # sort-merge joins at every size: a hot window or document is split by the adaptive planner
    later = windows.join(repeated.hint("merge"), ["__h1", "__h2"]).where(~place.eqNullSafe(F.col("first")))
    marks = later.groupBy(*_KEY).agg(F.collect_set("__pos").alias("__at"))
    marks = materialize(marks.select(F.col("__doc").alias("__d"), F.col("__tie").alias("__t"), "__at"), "covered-lines")

    names = docs.columns
    # the documents' own columns may be called anything
    doc, tie, d, t, at, x = unused(docs, "__doc", "__tie", "__d", "__t", "__at", "__x")
    marks = marks.withColumnsRenamed({"__d": d, "__t": t, "__at": at})
    keyed = docs.withColumns({doc: F.col("doc_id").cast("long"), tie: F.xxhash64("text")})
    found = keyed.join(marks.hint("merge"), F.col(doc).eqNullSafe(F.col(d)) & (F.col(tie) == F.col(t)), "left")
    # the split happens once per row: a one-row generator keeps it out of the lambdas below
    split = F.explode(F.array(F.struct(F.when(F.col(at).isNotNull(), _split("text")).alias("lines"))))
    held = found.select(*names, at, split.alias(x))
    covered = F.flatten(F.transform(at, lambda p: F.sequence(p, p + (lines - 1))))
    left = F.array_except(F.sequence(F.lit(0), F.size(f"{x}.lines") - 1), covered)
    cut = F.array_join(F.transform(left, lambda i: F.col(f"{x}.lines")[i]), "\n")
    text = F.when(F.col(at).isNull(), F.col("text")).otherwise(cut)
    result = [text.alias("text") if n == "text" else F.col(n) for n in names]
    if counts:
        n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
        n_removed = F.when(F.col(at).isNull(), 0).otherwise(F.size(F.array_distinct(covered)))
        result += [n_lines.cast("long").alias("n_lines"), n_removed.cast("long").alias("n_removed")]
    return held.select(*result)


ORACLE = """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls, text FROM documents),
w AS (
  SELECT doc_id, i, ls[i + 1] AS a, ls[i + 2] AS b, ls[i + 3] AS c
  FROM (SELECT doc_id, ls, unnest(range(0, len(ls) - 2)) AS i FROM d WHERE len(ls) >= 3)
),
t AS (SELECT * FROM w WHERE regexp_matches(concat(a, b, c), '[^ \\t\\n\\x0B\\f\\r]')),
r AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS nth FROM t),
v AS (SELECT DISTINCT doc_id, i + k AS line FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1),
g AS (SELECT doc_id, list(line) AS gone FROM v GROUP BY doc_id)
SELECT d.doc_id,
  CASE WHEN gone IS NULL THEN text
       ELSE array_to_string(list_filter(ls, lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text,
  CAST(len(ls) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN g USING (doc_id)
"""
