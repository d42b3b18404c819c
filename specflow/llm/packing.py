"""Packing of token sequences by a configuration linear program.

Only the histogram of piece lengths matters: at most ``capacity`` numbers.  A
configuration is a multiset of lengths that fits one sequence.  The linear
program covers every length's count with as few configurations as possible.

* Multiplicative weights: in each round a knapsack dynamic program prices all
  configurations; those within a slack of the best are used a small share of
  their demand, and the weight of a length grows or falls as it lags or leads.
* Rounding: configurations are used whole numbers of times, and what the chosen
  rounds leave is filled best fit, still over the histogram, each configuration
  as often as it can be used.  The number of rounds kept is the one whose
  rounding needs the fewest sequences (the later of equals).

The plan has at most (``rounds`` + 1) x ``capacity`` configurations whatever the
number of documents, so it may live on the driver.  Pieces find their place in it by
(length, running number within the length); running numbers are counted per task
and shifted by the counts of earlier tasks, so no length is gathered anywhere.

Null text: no ids but the end id.  Null or equal doc_id: each row is a document
and is packed on its own; the columns repeat.  Empty table: empty result.
Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from specflow.llm.tokens import DEFAULT_TOKENIZER, encoder
from specflow.llm.worker import bounded_slices
from specflow.session import materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _price(weight: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Most weight within each room, and the length taken there (0: none)."""
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, np.int64)
    lengths = np.flatnonzero(weight > 0)
    values = weight[lengths]
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fits[room]:
            gain = values[: fits[room]] + best[room - lengths[: fits[room]]]
            k = fits[room] - 1 - int(gain[::-1].argmax())  # of equals the longest
            if gain[k] > best[room]:
                best[room], take[room] = gain[k], lengths[k]
    return best, take


def _taken(take: np.ndarray, room: int) -> list[int]:
    out = []
    while room > 0:
        if take[room]:
            out.append(int(take[room]))
            room -= take[room]
        else:
            room -= 1
    return out


def _fill_best(left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """The longest piece left, then again and again the longest that still fits; each as often as it can be used."""
    left, out = left.copy(), []
    while left.any():
        after, room, lengths = left.copy(), capacity, []
        while len(fits := np.flatnonzero(after[: room + 1])):
            lengths.append(int(fits[-1]))
            after[fits[-1]] -= 1
            room -= fits[-1]
        kinds, each = np.unique(lengths, return_counts=True)
        times = int((left[kinds] // each).min())
        left[kinds] -= each * times
        out.append((np.array(lengths, np.int64), times))
    return out


def solve(counts: np.ndarray, capacity: int, *, rounds: int = 60, step: float = 0.05, eta: float = 1.0):
    """(lengths, times) per configuration; together they hold exactly ``counts`` pieces.

    counts[l] is the number of pieces of length l, for l up to capacity.
    """
    counts = np.asarray(counts, np.int64)
    left = counts.copy()
    plan: list[tuple[np.ndarray, int]] = []
    if left[capacity]:
        plan.append((np.array([capacity]), int(left[capacity])))
        left[capacity] = 0
    used = sum(times for _, times in plan)
    chosen = (used + sum(t for _, t in _fill_best(left, capacity)), len(plan), left.copy())
    size = np.arange(capacity + 1.0)
    weight = size * (1 + 0.01 * size / capacity)
    for turn in range(rounds):
        if not left.any():
            break
        slack = min(0.02, 0.001 * (turn + 1))  # how far below the best a configuration may weigh
        best, take = _price(np.where(left > 0, weight, 0.0), capacity)
        before = left.copy()
        for length in np.flatnonzero(before)[::-1]:
            if weight[length] + best[capacity - length] < (1 - slack) * best[capacity]:
                continue
            lengths = np.array([length, *_taken(take, capacity - length)])
            kinds, each = np.unique(lengths, return_counts=True)
            most = int((left[kinds] // each).min())
            if most:
                times = max(1, min(most, int(step * before[length])))
                left[kinds] -= each * times
                used += times
                plan.append((lengths, times))
        if (left == before).all():
            break
        open_ = before > 0
        share = (before - left) / np.maximum(before, 1)
        weight = np.where(open_, weight * np.exp(eta * np.clip(share[open_].mean() - share, -0.5, 0.5)), weight)
        total = used + sum(t for _, t in _fill_best(left, capacity))
        if total <= chosen[0]:
            chosen = (total, len(plan), left.copy())
    return plan[: chosen[1]] + _fill_best(chosen[2], capacity)


def slots_of(plan, capacity: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: running number at which each slot ends, its first sequence, its offset."""
    slots: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
    first = 0
    for lengths, times in plan:
        begins = np.cumsum(lengths) - lengths
        for length, begin in zip(lengths.tolist(), begins.tolist()):
            slots[length].append((times, first, begin))
        first += times
    columns = [np.array(x, np.int64).reshape(-1, 3).T for x in slots]
    return [(np.cumsum(times), firsts, begins) for times, firsts, begins in columns]


def find_slots(slots, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the piece that is number ``rank`` of its length."""
    sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    for kind in np.unique(length):
        ends, firsts, begins = slots[kind]
        at = np.flatnonzero(length == kind)
        slot = np.searchsorted(ends, rank[at], side="right")
        within = rank[at] - np.where(slot > 0, ends[slot - 1], 0)
        sequence[at] = firsts[slot] + within
        offset[at] = begins[slot]
    return sequence, offset


def cut_pieces(docs: DataFrame, *, capacity: int = 1024, tokenizer: str = DEFAULT_TOKENIZER, end_id: int = 2) -> DataFrame:
    """One row per piece: its place in the document, crc32 of its ids, number within task and length."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        code = encoder(tokenizer)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in bounded_slices(texts):
                rows = []
                for doc_id, ids in zip(doc_ids[a:b], code.encode(texts[a:b].to_pylist())):
                    whole = memoryview(ids + end)
                    n = len(whole) // 4
                    start, piece = 0, 0
                    length = (n - 1) % capacity + 1
                    while start < n:
                        crc = zlib.crc32(whole[4 * start : 4 * (start + length)])
                        rows.append((doc_id, piece, start, length, crc, part, seen[length]))
                        seen[length] += 1
                        start, piece, length = start + length, piece + 1, capacity
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def pack(
    docs: DataFrame,
    *,
    capacity: int = 1024,
    tokenizer: str = DEFAULT_TOKENIZER,
    end_id: int = 2,
    rounds: int = 60,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``."""
    pieces = materialize(cut_pieces(docs, capacity=capacity, tokenizer=tokenizer, end_id=end_id), "pieces")
    per_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    per_task = materialize(per_task, "piece-counts")  # at most tasks x capacity rows
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most capacity rows
        counts[row.length] = row.n
    slots = docs.sparkSession.sparkContext.broadcast(slots_of(solve(counts, capacity, rounds=rounds), capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    bases = materialize(bases, "piece-bases")

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            sequence, offset = find_slots(slots.value, length, batch.column("rank").to_numpy())
            keep = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(bases, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("base")).alias("rank")
    )
    return ranked.mapInArrow(place, PLACED)
