"""CSV records whose cells may span lines, read by many tasks however large a file is.

Spark's own reader gives a file with line breaks in cells to one task.  Here the
file is read as lines, which Spark splits.  Every split counts its quotes, and the
prefix sums of their parity tell whether a split begins inside a quoted cell.  With
that known each split puts its lines together on its own.  A record that crosses
splits leaves one piece in each of them; only those few pieces move.

Quotes must stand around cells, doubled inside them, as CSV asks for; a single quote
sign in the middle of an unquoted cell needs Spark's own reader.  Lines end with a
line feed, or carriage return and line feed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIECE = "text string, kind int, header boolean, mark long"
WHOLE, BEGIN, MIDDLE, END = range(4)


def csv_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """text, path per record of the files; the first record of a file, its header, is left out."""
    place = {"path": F.col("_metadata.file_path"), "start": F.col("_metadata.file_block_start")}
    lines = spark.read.option("lineSep", "\n").text(paths).select("value", *[c.alias(n) for n, c in place.items()])
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    splits = lines.groupBy("path", "start").agg((F.sum(quotes) % 2).alias("odd"))
    in_order = Window.partitionBy("path").orderBy("start")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    # all a task needs to know of a split in one number: 62 bits name it, one says that a cell is
    # open at its start, one that it begins the file
    name = F.xxhash64("path", "start").bitwiseAND(F.lit(-4).cast("long"))
    mark = name + inside * 2 + (F.col("start") == 0).cast("long")
    crossed = (inside == 1) | ((inside + F.col("odd")) % 2 == 1)
    borders = splits.select("path", "start", mark.alias("mark"), crossed.alias("crossed"))  # one row per split
    # a join that keeps the order of the lines; both scans must have cut the files alike
    known = lines.join(F.broadcast(borders), ["path", "start"], "left")
    unknown = F.raise_error(F.lit("the files were split in another way: read them again")).cast("long")
    known = known.select("value", F.coalesce("mark", unknown).alias("mark"), "crossed")

    def assembled(lines: DataFrame) -> DataFrame:
        return lines.select("value", "mark").mapInArrow(_assemble, PIECE).join(F.broadcast(borders), "mark")

    whole = assembled(known).where((F.col("kind") == WHOLE) & ~F.col("header")).select("text", "path")
    # only splits with a cell open at one of their ends hold pieces
    pieces = assembled(known.where("crossed")).where(F.col("kind") != WHOLE)
    in_file = Window.partitionBy("path").orderBy("start", F.col("kind") == BEGIN)  # an end comes before the next begin
    numbered = pieces.withColumn("record", F.count_if(F.col("kind") == BEGIN).over(in_file))
    parts = F.array_sort(F.collect_list(F.struct("start", F.col("kind") != BEGIN, "text")))
    joined = numbered.groupBy("path", "record").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"), F.bool_or("header").alias("header")
    )
    records = whole.unionByName(joined.where("NOT header").select("text", "path"))
    return records.select(_without_return("text").alias("text"), "path").where("text <> ''")


def _without_return(text: str) -> Column:
    return F.when(F.endswith(text, F.lit("\r")), F.expr(f"left({text}, length({text}) - 1)")).otherwise(F.col(text))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in their order -> whole records, and the pieces of records that cross a split."""
    split, held, inside, kind, header = None, [], False, BEGIN, False

    def out(texts: pa.Array, kind: int, header: bool = False) -> pa.RecordBatch:
        n = len(texts)
        first = np.zeros(n, bool)
        first[:1] = header
        columns = [texts, pa.repeat(pa.scalar(kind, pa.int32()), n), pa.array(first), pa.repeat(pa.scalar(split, pa.int64()), n)]
        return pa.RecordBatch.from_arrays(columns, names=["text", "kind", "header", "mark"])

    def joined(lines: list[pa.Array]) -> pa.Array:
        return pa.array(["\n".join(x for part in lines for x in part.to_pylist())], pa.string())

    def rest():  # what a split ends with belongs to a record that goes on
        if held:
            yield out(joined(held), kind, header)

    for batch in batches:
        if not batch.num_rows:
            continue
        marks = batch.column(1).to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], marks[1:] != marks[:-1]]))
        for a, b in zip(begins, [*begins[1:], batch.num_rows]):
            if marks[a] != split:
                yield from rest()
                split, held = int(marks[a]), []
                inside, header = bool(split & 2), bool(split & 1)
                kind = MIDDLE if inside else BEGIN
            lines = batch.column(0)[a:b]
            odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
            after = (int(inside) + np.cumsum(odd)) % 2
            inside = bool(after[-1])
            ends = np.flatnonzero(after == 0) + 1  # lines after which no cell is open
            if not len(ends):
                held.append(lines)
                continue
            yield out(joined([*held, lines[: ends[0]]]), END if kind == MIDDLE else WHOLE, header)
            if len(ends) > 1:
                grouped = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), lines)
                yield out(pc.binary_join(grouped, "\n"), WHOLE)
            held = [lines[ends[-1] :]] if ends[-1] < len(lines) else []
            kind, header = BEGIN, False
    yield from rest()


def infer_types(cells: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """The narrowest type all texts of a column fit, from one aggregate: int, bigint, decimal, double, date, timestamp, boolean, string."""

    tests, flags = [], []
    for i, name in enumerate(names):
        quoted = "`" + name.replace("`", "``") + "`"
        text = F.col(quoted)
        whole = text.rlike(r"^[+-]?[0-9]+$")
        number = text.rlike(r"^[+-]?(NaN|Infinity|[0-9]+[.]?[0-9]*([eE][+-]?[0-9]+)?|[.][0-9]+([eE][+-]?[0-9]+)?)$")
        tests = [
            ("int", whole & text.try_cast("int").isNotNull()),
            ("bigint", whole & text.try_cast("bigint").isNotNull()),
            ("decimal", whole & (F.length(text) <= 38)),
            ("double", number),
            ("date", text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull()),
            ("timestamp", text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}") & text.try_cast("timestamp").isNotNull()),
            ("boolean", F.lower(text).isin("true", "false")),
        ]
        flags += [F.bool_and(text.isNull() | F.coalesce(test, F.lit(False))).alias(f"{kind}{i}") for kind, test in tests]
        flags += [F.count(text).alias(f"n{i}"), F.max(F.length(F.regexp_replace(text, "^[+-]?0*", ""))).alias(f"digits{i}")]
    if not flags:
        return {}
    row = cells.agg(*flags).first()
    kinds = {}
    for i, name in enumerate(names):
        fit = next((kind for kind, _ in tests if row[f"{kind}{i}"]), "string") if row[f"n{i}"] else "string"
        kinds[name] = f"decimal({max(1, row[f'digits{i}'])},0)" if fit == "decimal" else fit
    return kinds
