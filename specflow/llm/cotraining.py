"""Document quality from two views that teach each other.

The content view sees hashed words and shapes of the text, the metadata view the
source, language and size of the document.  Each is a logistic regression.  In
every round each view labels the unlabelled pool, and its most confident labels of
either class join the other view's training set.  Afterwards each view is
calibrated (Platt) on labelled rows that neither trained on, and a logistic
regression on the two calibrated log odds scores every document.

The pool is every unlabelled document: its features are written once, sparse, and
each pass over them runs in tasks that hand back sums of bounded size, the counts of
log odds from which a round's most confident share follows, or gradient and Hessian
of both views.  What a document was given in earlier rounds is worked out again from
those rounds' models, so no label is stored.  Only labelled rows are sampled: at most
about ``sample`` that have a document, as evenly from both classes as these allow,
drawn by a hash of doc_id and weighted back to their shares; a third calibrates.
Scoring covers whole texts of all rows.

Null or empty text: all content features zero.  Null source, lang or n_chars:
features of their own.  Rows without doc_id are scored, never trained on; of
several labels of a doc_id the lowest counts.  Without rows of both classes the
score is 0.5 everywhere.  Repeated rows score alike.  Empty table: empty result.
Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.llm.worker import bounded_slices, kept
from specflow.session import materialize

HASHED = 512
SHAPES = 10
META = 256
BINS = 6000
SURE = 2779  # the last bin below a probability of 0.1
STEPS, LAST_STEPS = 3, 6  # Newton steps of a round, each one pass over the pool
PARTIAL = 4096  # most partial sums of one pass, each of 1.4 MB
SUMMED = 16  # partial sums that reach the driver
WORD = re.compile(r"\S+")
SCORED = "doc_id long, content_score double, metadata_score double, score double, good boolean"


def content_features(text: str | None, places: dict[str, int]) -> np.ndarray:
    """Length-normalised log counts of hashed words, then shapes of the text."""
    out = np.zeros(HASHED + SHAPES, np.float32)
    words = text.lower().split() if text else []
    if not words:
        return out
    for w in words:
        if w not in places:
            places[w] = crc32(w.encode()) % HASHED
    counts = np.bincount(np.fromiter(map(places.__getitem__, words), np.int64, len(words)), minlength=HASHED)
    logs = np.log1p(counts)
    out[:HASHED] = logs / np.sqrt((logs * logs).sum()) * 3
    n, m = len(text), len(words)
    distinct = len(set(words))
    lines = text.split("\n")
    raw = text.encode()
    odd = n - sum(map(len, words))
    marks = sum(text.count(c) for c in ".,;:!?")
    symbols = sum(raw.count(c) for c in (b"|", b"{", b"}", b"<", b">", b"#", b"=", b"/", b"@"))
    digits = sum(raw.count(b"%d" % d) for d in range(10))
    out[HASHED:] = (
        math.log1p(m) / 4, distinct / m, (n / m) / 8, marks / m, min(3.0, symbols / m), min(3.0, digits / m),
        len(set(lines)) / len(lines), math.log1p(len(lines)) / 3, odd / n, max(map(len, words)) / 40,
    )
    return out


def metadata_features(source, lang, n_chars) -> np.ndarray:
    """Hashed source, language and size class, alone and in pairs, and the size itself."""
    out = np.zeros(META + 1, np.float32)
    size = "none" if n_chars is None else str(int(math.log2(max(1, n_chars)) * 2))
    names = [f"s={source}", f"l={lang}", f"n={size}", f"s={source} l={lang}", f"l={lang} n={size}"]
    for name in names:
        out[crc32(name.encode()) % META] += 1
    out[META] = 0 if n_chars is None else math.log1p(max(0, n_chars)) / 5
    return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, penalty: float = 1e-3, steps: int = 25):
    """Weights (the last is the intercept) by Newton steps with a ridge."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(float)
    weight = np.ones(len(y)) if weight is None else weight
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty * len(y))
    ridge[-1] = 1e-6 * len(y)
    for _ in range(steps):
        p = _sigmoid(x @ w)
        grad = x.T @ (weight * (p - y)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def bins_of(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Log odds in steps of a hundredth."""
    return ((np.clip(odds(x, w), -30, 29.99) + 30) * 100).astype(np.int64)


def given(views: list[np.ndarray], history: list) -> tuple[list[np.ndarray], np.ndarray]:
    """Label (-1: none) of pool rows for either view after the rounds of ``history``, and which rows have none at all."""
    left = np.ones(len(views[0]), bool)
    labels = [np.full(len(left), -1), np.full(len(left), -1)]
    for models, cuts in history:
        gone = np.zeros(len(left), bool)
        for k, (low, high) in enumerate(cuts):
            at = bins_of(views[k], models[k])
            for label, hit in ((0, left & (at <= low)), (1, left & (at >= high))):
                labels[1 - k][hit] = label
                gone |= hit
        left &= ~gone
    return labels, left


def pool_counts(views: list[np.ndarray], history: list, models: list) -> np.ndarray:
    """(views, BINS) rows without a label by the log odds of either view."""
    left = given(views, history)[1]
    return np.stack([np.bincount(bins_of(v[left], m), minlength=BINS) for v, m in zip(views, models)])


def pool_sums(views: list[np.ndarray], history: list, models: list) -> np.ndarray:
    """Rows, gradient and upper half of the Hessian of each view's labelled pool rows, end to end."""
    out = []
    for view, y, w in zip(views, given(views, history)[0], models):
        x, y = np.hstack([view[y >= 0], np.ones((int((y >= 0).sum()), 1), np.float32)]).astype(np.float32), y[y >= 0]
        p = _sigmoid(x @ w)
        curve = (x * (p * (1 - p))[:, None].astype(np.float32)).T @ x
        out += [[len(y)], x.T @ (p - y), curve[np.triu_indices(len(w))]]
    return np.concatenate(out).astype(float)


def _cuts(counts: np.ndarray, prior: float, share: float) -> list[tuple[int, int]]:
    """Last bin of the most confident zeros and first bin of the ones, by view; a bin goes as a whole."""
    out = []
    for row in counts:
        most = max(1, int(share * row.sum()))
        low = int(np.searchsorted(np.cumsum(row), max(1, int(most * (1 - prior)))))
        high = BINS - 1 - int(np.searchsorted(np.cumsum(row[::-1]), max(1, int(most * prior))))
        out.append((min(low, SURE), max(high, BINS - 1 - SURE)))
    return out


def _refit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray, n: float, grad: np.ndarray, curve: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """One Newton step from ``w`` on rows held here and the sums of the pool."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(float)
    ridge = np.full(x.shape[1], penalty * (len(y) + n))
    ridge[-1] = 1e-6 * (len(y) + n)
    p = _sigmoid(x @ w)
    grad = grad + x.T @ (weight * (p - y)) + ridge * w
    curve = curve + (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
    return np.linalg.solve(curve, grad)


def co_train(
    content: np.ndarray, metadata: np.ndarray, label: np.ndarray, part: np.ndarray, *,
    rounds: int = 4, share: float = 0.1, weight: np.ndarray | None = None, pool=None,
) -> dict | None:
    """label: 0, 1 or -1 (pool); part 0 of the labelled rows calibrates.

    ``pool(what, history, models)`` sums ``what`` over a pool that is elsewhere, instead of the rows labelled -1.
    """
    views = [content, metadata]
    weight = np.ones(len(label)) if weight is None else weight
    train, held = np.flatnonzero((label >= 0) & (part > 0)), np.flatnonzero((label >= 0) & (part == 0))
    if len(set(label[train])) < 2 or len(set(label[held])) < 2:
        return None
    if pool is None:
        here = [v[label < 0] for v in views]

        def pool(what, history, models):
            return what(here, history, models)

    y, sure = label[train].astype(float), label[held].astype(float)
    prior = np.average(y, weights=weight[train])
    models = [logistic(v[train], y, weight[train]) for v in views]
    history: list = []
    for turn in range(rounds):
        counts = pool(pool_counts, history, models)
        if not counts[0].sum():
            break
        cuts = _cuts(counts, prior, share)
        if not any(c[: low + 1].sum() + c[high:].sum() for c, (low, high) in zip(counts, cuts)):
            break
        history.append((models, cuts))
        for _ in range(LAST_STEPS if turn == rounds - 1 else STEPS):
            sums = pool(pool_sums, history, models)
            new, largest = [], 0.0
            for v, w in zip(views, models):
                m = len(w)
                half = m * (m + 1) // 2
                n, grad, curve = sums[0], sums[1 : m + 1], np.zeros((m, m))
                curve[np.triu_indices(m)] = sums[m + 1 : m + 1 + half]
                curve += np.triu(curve, 1).T
                sums = sums[m + 1 + half :]
                step = _refit(v[train], y, weight[train], w, n, grad, curve)
                new.append(w - step)
                largest = max(largest, float(np.abs(step).max()))
            models = new
            if largest < 1e-3:
                break
    calibrated = [logistic(odds(v[held], m)[:, None], sure, weight[held]) for v, m in zip(views, models)]
    both = np.stack([odds(odds(v[held], m)[:, None], c) for v, m, c in zip(views, models, calibrated)], axis=1)
    return {"models": models, "calibrated": calibrated, "combined": logistic(both, sure, weight[held])}


def score_views(content: np.ndarray, metadata: np.ndarray, model: dict | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if model is None:
        half = np.full(len(content), 0.5)
        return half, half, half
    z = [odds(odds(v, m)[:, None], c) for v, m, c in zip((content, metadata), model["models"], model["calibrated"])]
    return _sigmoid(z[0]), _sigmoid(z[1]), _sigmoid(odds(np.stack(z, axis=1), model["combined"]))


def _inputs(docs: DataFrame) -> list:
    return [
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("long").alias("n_chars"),
    ]


def _features(batch: pa.RecordBatch, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    places = kept("quality_words", dict)
    if len(places) > 500_000:
        places.clear()
    content = np.stack([content_features(t, places) for t in batch.column("text")[a:b].to_pylist()])
    meta = zip(*(batch.column(n)[a:b].to_pylist() for n in ("source", "lang", "n_chars")))
    return content, np.stack([metadata_features(*m) for m in meta])


def _packed(row: np.ndarray) -> bytes:
    at = np.flatnonzero(row).astype("<u2")
    return at.tobytes() + row[at].astype("<f4").tobytes()


def _dense(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.float32)
    for row, packed in zip(out, column.to_pylist()):
        n = len(packed) // 6
        row[np.frombuffer(packed, "<u2", n)] = np.frombuffer(packed, "<f4", n, 2 * n)
    return out


def _views(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [_dense(batch.column("content"), HASHED + SHAPES), _dense(batch.column("meta"), META + 1)]


def _summed(batches):
    total = None
    for batch in batches:
        for cell in batch.column(0).to_pylist():
            some = np.frombuffer(cell, float)
            total = some if total is None else total + some
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def _pool_of(table: DataFrame):
    """``pool`` of ``co_train`` over stored features: sums per task, added up in ``SUMMED`` tasks, then here.

    At most ``PARTIAL`` tasks, so a pass shuffles no more than 6 GB however large the table.
    """

    def pool(what, history, models):
        def partial(batches):
            total = None
            for batch in batches:
                for at in range(0, batch.num_rows, 2048):
                    some = what(_views(batch.slice(at, 2048)), history, models).astype(float)
                    total = some if total is None else total + some
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        sums = table.coalesce(PARTIAL).mapInArrow(partial, "sums binary").repartition(SUMMED).mapInArrow(_summed, "sums binary").collect()
        empty = [np.zeros((0, HASHED + SHAPES), np.float32), np.zeros((0, META + 1), np.float32)]
        nothing = what(empty, history, models).astype(float)
        return sum((np.frombuffer(r.sums, float).reshape(nothing.shape) for r in sums), nothing)

    return pool


def train(docs: DataFrame, labels: DataFrame, *, sample: int = 9_000, **settings) -> dict | None:
    """Model from all unlabelled documents and about ``sample`` labelled ones; only features of the latter reach the driver."""
    rows = docs.select(*_inputs(docs)).where("doc_id IS NOT NULL")
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.where("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))

    def extract(batches):
        for batch in batches:
            for a, b in bounded_slices(batch.column("text")):
                content, meta = _features(batch, a, b)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b], pa.array([_packed(c) for c in content], pa.binary()), pa.array([_packed(m) for m in meta], pa.binary())],
                    names=["doc_id", "content", "meta"],
                )

    features = rows.mapInArrow(extract, "doc_id long, content binary, meta binary").join(marks.hint("merge"), "doc_id", "left")
    features = materialize(features, "quality-features")
    known = features.where("quality IS NOT NULL")
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}  # two rows
    if len(counts) < 2:
        return None
    few = min(counts.values())
    share = {q: min(1.0, max(sample / 2, sample - few) / n) for q, n in counts.items()}
    span = 1 << 30
    limit = F.when(F.col("quality") == 0, int(span * share[0])).otherwise(int(span * share[1]))
    found = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < limit).collect()  # about ``sample`` rows; the scan keeps its tasks
    found.sort(key=lambda r: (r.doc_id, r.content))
    columns = [pa.array([r[c] for r in found], pa.binary()) for c in ("content", "meta")]
    label = np.array([r.quality for r in found], int)
    part = np.array([crc32(str(r.doc_id).encode()) % 3 for r in found])
    weight = np.array([1 / share[q] for q in label.tolist()])
    weight = weight / weight.mean() if len(weight) else weight
    views = _dense(columns[0], HASHED + SHAPES), _dense(columns[1], META + 1)
    pool = _pool_of(features.where("quality IS NULL").select("content", "meta"))
    return co_train(*views, label, part, weight=weight, pool=pool, **settings)


def score_documents(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, content_score, metadata_score, score (probability of quality 1), good (score at least 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def score(batches):
        for batch in batches:
            for a, b in bounded_slices(batch.column("text")):
                first, second, both = score_views(*_features(batch, a, b), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b], pa.array(first), pa.array(second), pa.array(both), pa.array(both >= 0.5)],
                    names=["doc_id", "content_score", "metadata_score", "score", "good"],
                )

    return docs.select(*_inputs(docs)).mapInArrow(score, SCORED)
