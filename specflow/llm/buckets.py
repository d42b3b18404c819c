"""Comparing the members of many buckets, whatever their sizes.

A bucket is cut into chunks of about ``chunk`` members, and every pair of chunks
is a cell of its own, so the largest task holds two chunks however large the
bucket; one chunk is the usual case and the same code.  Inside a task the pairs
of a cell exist only as numpy indexes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.session import materialize

SMALL = 48
ROWS = 64
AT_ONCE = 200_000


def cells(postings: DataFrame, node: str, *, payload: DataFrame | None = None, chunk: int = 1024) -> DataFrame:
    """postings (bucket long, node, ...) -> rows of (bucket, i, j, side), sorted so that a cell is one run.

    Members of buckets of one are left out.  Columns of ``payload`` (one row per
    node) join only then, so wide values travel once and not for single members.
    ``postings`` is evaluated twice and must give the same rows, so pass something
    derived from a stored table.
    """
    sizes = postings.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = materialize(sizes.select("bucket", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")), "bucket-sizes")
    dealt = postings.join(sizes, "bucket").withColumn("own", F.pmod(F.hash(F.lit(7), node), "chunks"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    spread = dealt.select("*", other).select(
        *postings.columns,
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).alias("side"),
    )
    if payload is not None:
        spread = spread.join(payload, node)
    return spread.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")


def runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Whole cells, many at a time: start of each cell, whether it is a cell of two chunks, its columns."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def cut(final: bool):
        nonlocal held, rows
        table = pa.Table.from_batches(held).combine_chunks()
        n = table.num_rows
        keys = [table.column(c).to_numpy() for c in ("bucket", "i", "j")]
        new = np.ones(n, bool)
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        starts = np.flatnonzero(new)
        stop = n if final else starts[-1]
        held = [] if stop == n else table.slice(stop).to_batches()
        rows = n - stop
        if stop:
            part = table.slice(0, stop)
            starts = starts[starts < stop]
            yield starts, (keys[1] != keys[2])[starts], [part.column(c).combine_chunks() for c in columns]

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= AT_ONCE:
            yield from cut(False)
    if rows:
        yield from cut(True)


def pairs(
    starts: np.ndarray,
    crossed: np.ndarray,
    side: np.ndarray,
    n: int,
    test: Callable[[np.ndarray, np.ndarray], np.ndarray],
    grid: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of the cells that pass ``test``, in portions.  A crossed cell compares its two chunks only.

    In large cells ``grid`` may rule out pairs of some rows with others as a whole before ``test``.
    """
    ends = np.append(starts[1:], n)
    sizes = ends - starts
    small = sizes <= SMALL
    reach = np.repeat(np.where(small, ends, 0), sizes)  # end of a row's cell, 0 for large cells
    cross = np.repeat(crossed, sizes)
    rows = np.flatnonzero(reach)
    for step in range(1, int(sizes[small].max()) if small.any() else 0):
        rows = rows[rows + step < reach[rows]]
        a, b = rows, rows + step
        ok = ~cross[a] | (side[a] != side[b])
        a, b = a[ok], b[ok]
        hit = test(a, b)
        if hit.any():
            yield a[hit], b[hit]
    for k in np.flatnonzero(~small):
        members = np.arange(starts[k], ends[k])
        left, right = (members[~side[members]], members[side[members]]) if crossed[k] else (members, members)
        for at in range(0, len(left), ROWS):
            some = left[at : at + ROWS]
            open_ = np.ones((len(some), len(right)), bool) if grid is None else grid(some, right)
            if not crossed[k]:
                open_ &= some[:, None] < right[None, :]
            x, y = np.nonzero(open_)
            a, b = some[x], right[y]
            hit = test(a, b)
            if hit.any():
                yield a[hit], b[hit]


class Forest:
    """Joins rows that are linked; keeps one link per row that is not its group's first."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def _root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def _roots(self, x: np.ndarray) -> np.ndarray:
        x = self.up[x]
        while ((above := self.up[x]) != x).any():
            x = above
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self._roots(a), self._roots(b)
        apart = a != b
        for x, y in np.unique(np.stack([a[apart], b[apart]], axis=1), axis=0).tolist():
            x, y = self._root(x), self._root(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        rows = np.flatnonzero(self.up != np.arange(len(self.up)))
        return rows, self.up[rows]
