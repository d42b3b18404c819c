"""Hard negatives of anchor vectors by angular triangle filtering and exact integer scores.

Components become floor(256 x); a score is the integer inner product of two rows.
An anchor's positives are the best rows of its label, the hard negatives of a
positive the best rows of another label whose score lies between two percentages
of the positive's.

Stored with every row are its norm and its angles to a few reference directions.
By the triangle inequality the angle between an anchor and a row is at least the
difference of their angles to any reference and at most their sum, so it lies in an
interval, its cosine in one too, and times both norms that bounds the score (with a
margin above all rounding).  Rows are stored by label, nearest reference and angle to it;
``WINDOW`` neighbours of that order share the hull of their angles and norms.  Only
windows whose score bounds overlap what an anchor still looks for (its best scores
so far; the range of a positive) get integer scoring.  The result does not depend on
the references, which are taken from a bounded sample of ``SAMPLE`` rows.

Anchors are a stated query set.  They are taken in blocks of at most about
``block_bytes`` bytes, each broadcast to one scan of all rows for the positives and
one for the negatives; a task hands on its best few rows per anchor, and the best of
all are picked by Spark.

Rows with a null label, vec_id or vector, with a null or non-finite component (also
after multiplying by 256), or with an empty vector take no part.  Vectors of
different lengths never meet.  Every row counts, also repeated ones: other rows are
those of another vec_id, and each anchor row has its own positives and negatives.
Ties go to the smaller vec_id.  Scores beyond 64 bits are ordered exactly and shown
as the largest or smallest long.  Empty table: empty result.  Other columns are
ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specflow.session import materialize, partitions_for

SAMPLE = 4096
REFERENCES = 12
WINDOW = 64
AT_ONCE = 300_000  # candidates held before they are reduced to the best
SEEDS = 512
EXACT = float(1 << 53)
MEMBER = "vec_id long, label int, length int, norm double, vector binary, angles binary, near int, angle double"


def _integers(x: np.ndarray) -> np.ndarray | None:
    """floor(256 x); None if a component is not finite."""
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(x * 256.0) + 0.0
    return scaled if len(scaled) and np.isfinite(scaled).all() else None


def _norms(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, initial=0)
    with np.errstate(over="ignore"):
        return top * np.sqrt(((x / np.where(top, top, 1)[:, None]) ** 2).sum(axis=1))


def _angles(x: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of the rows of ``x`` to unit vectors; a zero row gets 0, its norm makes every bound 0."""
    top = np.abs(x).max(axis=1, initial=0)
    unit = x / np.where(top, top, 1)[:, None]
    length = np.sqrt((unit * unit).sum(axis=1))
    return np.arccos(np.clip(unit @ references.T / np.where(length, length, 1)[:, None], -1, 1))


def pick_references(sample: list[np.ndarray], count: int = REFERENCES) -> dict[int, np.ndarray]:
    """For each length of vector up to ``count`` unit vectors of the sample, each far from those before."""
    out = {}
    for length in sorted({len(x) for x in sample}):
        x = np.array([v for v in sample if len(v) == length])
        norms = _norms(x)
        unit = x[norms > 0] / norms[norms > 0][:, None]
        unit = unit[np.isfinite(unit).all(axis=1)]
        chosen, closest = [], np.full(len(unit), -np.inf)
        while len(unit) and len(chosen) < count:
            at = int(closest.argmin()) if chosen else 0
            if closest[at] > 1 - 1e-9:
                break
            chosen.append(unit[at])
            closest = np.maximum(closest, unit @ unit[at])
        out[length] = np.array(chosen) if chosen else np.eye(1, length)
    return out


def index_rows(vectors: DataFrame, *, every: tuple[int, int] | None = None, labels: int | None = None) -> DataFrame:
    """Usable rows as stored members (``MEMBER``), in the order of windows.

    With ``every`` = (m, k) and ``labels``, rows whose vec_id is divisible by m have
    their label moved on by k, modulo ``labels``, first.
    """
    label: Column = F.col("label").cast("long")
    if every is not None:
        label = F.when(F.col("vec_id") % every[0] == 0, (label + every[1]) % labels).otherwise(label)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    # a bounded sample chosen by hash: the result does not depend on it
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", F.xxhash64("v")).limit(SAMPLE).select("v").collect()
    usable = [_integers(np.array([np.nan if c is None else c for c in r.v], float)) for r in sample]
    shared = vectors.sparkSession.sparkContext.broadcast(pick_references([x for x in usable if x is not None]))

    def measure(batches):
        for batch in batches:
            held: dict[int, tuple[list, list, list]] = {}
            for vec_id, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                x = _integers(np.array(v.values.to_numpy(zero_copy_only=False), float))
                if x is not None:
                    for column, value in zip(held.setdefault(len(x), ([], [], [])), (vec_id, label, x)):
                        column.append(value)
            for length, (vec_ids, own, found) in held.items():
                x = np.array(found)
                references = shared.value.get(length, np.eye(1, length))  # a length outside the sample
                angles = _angles(x, references)
                small = np.abs(x).max(axis=1) < 1 << 31
                raw = [(r.astype("<i4") if s else r.astype("<f8")).tobytes() for r, s in zip(x, small)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(vec_ids, pa.int64()), pa.array(own, pa.int32()), pa.array([length] * len(own), pa.int32()), pa.array(_norms(x)),
                     pa.array(raw, pa.binary()), pa.array([a.astype("<f8").tobytes() for a in angles], pa.binary()), pa.array(angles.argmin(axis=1), pa.int32()), pa.array(angles.min(axis=1))],
                    names=["vec_id", "label", "length", "norm", "vector", "angles", "near", "angle"],
                )

    members = rows.mapInArrow(measure, MEMBER)
    order = ["length", "label", "near", "angle", "vec_id"]
    return materialize(members.repartitionByRange(partitions_for(vectors), *order).sortWithinPartitions(*order), "angular-index")


@dataclass(frozen=True)
class Rows:
    """Members of one length as arrays."""

    vec_id: np.ndarray
    label: np.ndarray
    norm: np.ndarray
    x: np.ndarray
    angles: np.ndarray

    def __len__(self) -> int:
        return len(self.vec_id)

    def __getitem__(self, some: slice) -> Rows:
        return Rows(*[getattr(self, f.name)[some] for f in fields(self)])


def _read(batch: pa.RecordBatch):
    """(length, Rows) of the members of a batch."""
    lengths = batch.column("length").to_numpy()
    for length in np.unique(lengths).tolist():
        part = batch.filter(pa.array(lengths == length))
        x = np.empty((part.num_rows, length))
        for at, raw in enumerate(part.column("vector").to_pylist()):
            x[at] = np.frombuffer(raw, "<i4" if len(raw) == 4 * length else "<f8")
        angles = np.frombuffer(b"".join(part.column("angles").to_pylist()), "<f8").reshape(len(x), -1)
        vec_id, label, norm = (part.column(c).to_numpy() for c in ("vec_id", "label", "norm"))
        yield length, Rows(vec_id, label, norm, x, angles)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows: doubles while those are exact, Python's integers beyond."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < EXACT:
        return a @ b.T
    whole = [[int(v) for v in row] for row in a], [[int(v) for v in row] for row in b]
    return np.array([[sum(map(int.__mul__, x, y)) for y in whole[1]] for x in whole[0]], object).reshape(len(a), len(b))


def window_bounds(anchors: Rows, rows: Rows, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchors, windows) lower and upper bounds of the scores of the windows that begin at ``starts``."""
    low, high = (f.reduceat(rows.angles, starts) for f in (np.minimum, np.maximum))
    least, most = np.zeros((len(anchors), len(starts))), np.full((len(anchors), len(starts)), math.pi)
    for r in range(low.shape[1]):  # the nearest and the farthest the angle can be, by each reference
        own = anchors.angles[:, r][:, None]
        np.maximum(least, np.maximum(low[None, :, r] - own, own - high[None, :, r]), out=least)
        total = own + high[None, :, r]
        np.minimum(most, np.where(total > math.pi, np.minimum(math.pi, 2 * math.pi - own - low[None, :, r]), total), out=most)
    short, long = np.minimum.reduceat(rows.norm, starts), np.maximum.reduceat(rows.norm, starts)
    with np.errstate(over="ignore", invalid="ignore"):
        top, bottom = np.cos(least), np.cos(np.maximum(most, least))
        reach = anchors.norm[:, None] * long[None, :]
        upper = anchors.norm[:, None] * np.where(top >= 0, long, short) * top
        lower = anchors.norm[:, None] * np.where(bottom >= 0, short, long) * bottom
        margin = 1 + 1e-7 * reach  # angles near 0 are good to about 2e-8
        return np.nan_to_num(lower - margin, nan=-np.inf), np.nan_to_num(upper + margin, nan=np.inf)


class Best:
    """The best ``keep`` (score, vec_id) of each of ``n`` searches, fed with candidates."""

    def __init__(self, n: int, keep: int, floor: np.ndarray | None = None):
        self.n, self.keep = n, keep
        self.least = np.full(n, -np.inf) if floor is None else floor  # scores below can no longer count
        self.held: list[tuple] = []
        self.size = 0

    def add(self, search: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        if len(search):
            self.held.append((search, score, vec_id))
            self.size += len(search)
            if self.size > AT_ONCE + self.n * self.keep:
                self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            return np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        search, score, vec_id = (np.concatenate(c) for c in zip(*self.held))
        order = np.array(sorted(range(len(score)), key=lambda i: (search[i], -score[i], vec_id[i])), np.int64) if score.dtype == object else np.lexsort((vec_id, -score, search))
        search, score, vec_id = search[order], score[order], vec_id[order]
        first = np.searchsorted(search, search, side="left")
        nth = np.arange(len(search)) - first
        some = nth < self.keep
        full = nth == self.keep - 1
        np.maximum.at(self.least, search[full], score[full].astype(float) * (1 - 1e-15 * np.sign(score[full].astype(float))))
        self.held = [(search[some], score[some], vec_id[some])]
        self.size = int(some.sum())
        return self.held[0]


def _long(score: np.ndarray) -> pa.Array:
    ends = (1 << 63) - 1
    if score.dtype == object:
        return pa.array([max(-ends - 1, min(ends, int(s))) for s in score], pa.int64())
    return pa.array(score.astype(np.int64))


def search_positives(anchors: Rows, rows: Rows, best: Best) -> None:
    """Feed ``best`` (one search per anchor) with rows of the anchor's label."""
    starts = np.arange(0, len(rows), WINDOW)
    _, upper = window_bounds(anchors, rows, starts)
    for w, begin in enumerate(starts):
        part = slice(begin, begin + WINDOW)
        some = np.flatnonzero((upper[:, w] >= best.least) & np.isin(anchors.label, rows.label[part]))
        if not len(some):
            continue
        score = scores(anchors.x[some], rows.x[part])
        wanted = (anchors.label[some][:, None] == rows.label[part]) & (anchors.vec_id[some][:, None] != rows.vec_id[part])
        a, b = np.nonzero(wanted & (score >= best.least[some][:, None]))
        best.add(some[a], score[a, b], rows.vec_id[part][b])


def search_negatives(anchors: Rows, rows: Rows, owner: np.ndarray, low: np.ndarray, high: np.ndarray, best: Best) -> None:
    """Feed ``best`` (one search per positive, of anchor ``owner``) with rows of other labels scored ``low`` to ``high``."""
    starts = np.arange(0, len(rows), WINDOW)
    lower, upper = window_bounds(anchors, rows, starts)
    for w, begin in enumerate(starts):
        part = slice(begin, begin + WINDOW)
        open_ = np.flatnonzero((upper[owner, w] >= np.maximum(best.least, low.astype(float) * (1 - 1e-15))) & (lower[owner, w] <= high.astype(float) * (1 + 1e-15)))
        if not len(open_):
            continue
        some, back = np.unique(owner[open_], return_inverse=True)
        score = scores(anchors.x[some], rows.x[part])
        other = anchors.label[some][:, None] != rows.label[part]
        score, other = score[back], other[back]
        fits = other & (score >= low[open_][:, None]) & (score <= high[open_][:, None]) & (score >= best.least[open_][:, None])
        a, b = np.nonzero(fits)
        best.add(open_[a], score[a, b], rows.vec_id[part][b])


def _best_of_all(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("search").orderBy(F.col("score").desc(), "vec_id", "copy")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep).drop("copy")


def mine(
    vectors: DataFrame,
    *,
    anchors: int = 50,
    positives: int = 5,
    negatives: int = 3,
    between: tuple[int, int] = (50, 95),
    relabel: tuple[int, int] | None = (7, 1),
    labels: int = 10,
    block_bytes: int = 16_000_000,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ``anchors``; a negative's score
    is between the two percentages of the positive's.
    """
    spark = vectors.sparkSession
    members = index_rows(vectors, every=relabel, labels=labels)
    queries = members.where(F.col("vec_id") % anchors == 0)
    # each anchor row has a number of its own, whatever its vec_id
    queries = materialize(queries.withColumn("row", F.monotonically_increasing_id()), "anchors")
    size = queries.agg(F.coalesce(F.sum(F.length("vector") * 2 + F.length("angles") + 64), F.lit(0)).alias("bytes")).first().bytes
    blocks = max(1, -(-size // block_bytes))
    result = None
    for k in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == k)
        mined = _mine_block(spark, members, block, positives, negatives, between)
        mined = mined if blocks == 1 else materialize(mined, "hard-negatives")
        result = mined if result is None else result.unionByName(mined)
    return result


def _mine_block(spark, members: DataFrame, block: DataFrame, positives: int, negatives: int, between: tuple[int, int]) -> DataFrame:
    table = block.orderBy("row").toArrow().combine_chunks()  # a block has at most about ``block_bytes``
    groups = {}
    for batch in table.to_batches():
        numbers, lengths = batch.column("row").to_numpy(), batch.column("length").to_numpy()
        for length, rows in _read(batch):
            # lower bounds of the last positive: the best among some anchors, which are rows themselves
            best = Best(len(rows), positives)
            search_positives(rows, rows[:SEEDS], best)
            best.reduce()
            groups[length] = (rows, numbers[lengths == length], best.least)
    shared = spark.sparkContext.broadcast(groups)
    schema = "search long, score long, vec_id long, copy int"

    def out(numbers, best: Best) -> pa.RecordBatch:
        search, score, vec_id = best.reduce()
        copy = np.arange(len(search), dtype=np.int32)
        return pa.RecordBatch.from_arrays([pa.array(numbers[search]), _long(score), pa.array(vec_id), pa.array(copy)], names=["search", "score", "vec_id", "copy"])

    def find_positives(batches):
        best = {length: Best(len(rows), positives, floor.copy()) for length, (rows, _, floor) in shared.value.items()}
        for batch in batches:
            for length, rows in _read(batch):
                if length in best:
                    search_positives(shared.value[length][0], rows, best[length])
        for length, found in best.items():
            yield out(shared.value[length][1], found)

    found = _best_of_all(members.mapInArrow(find_positives, schema), positives)
    found = materialize(found, "positives").orderBy("search", "rank").collect()  # a few rows per anchor of the block
    place = {int(n): (length, i) for length, (_, numbers, _) in groups.items() for i, n in enumerate(numbers)}
    wanted = {length: [] for length in groups}
    for number, r in enumerate(found):
        length, i = place[r.search]
        low, high = -(-between[0] * r.score // 100), between[1] * r.score // 100
        if low <= high:
            wanted[length].append((number, i, low, high))
    ranges = {
        length: tuple(np.array(c, np.int64) for c in zip(*w)) for length, w in wanted.items() if w
    }  # number of the search, anchor, lowest and highest score
    asked = spark.sparkContext.broadcast(ranges)

    def find_negatives(batches):
        best = {length: Best(len(r[0]), negatives) for length, r in asked.value.items()}
        for batch in batches:
            for length, rows in _read(batch):
                if length in best:
                    search_negatives(shared.value[length][0], rows, *asked.value[length][1:], best[length])
        for length, kept in best.items():
            yield out(asked.value[length][0], kept)

    near = _best_of_all(members.mapInArrow(find_negatives, schema), negatives)
    pairs = [(number, int(groups[place[r.search][0]][0].vec_id[place[r.search][1]]), r.vec_id, r.score) for number, r in enumerate(found)]
    named = spark.createDataFrame(pairs, "search long, anchor_id long, positive_id long, positive_score long")
    joined = near.join(F.broadcast(named), "search")  # a few rows per anchor of the block
    return joined.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


ORACLE = """
WITH fit AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM fit a JOIN fit b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""
