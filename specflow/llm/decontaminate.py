"""Finding benchmark passages in documents by q-gram lemma filtering.

Texts are compared lower-cased with runs of white space as one blank.  A
benchmark item is cut into overlapping passages of ``window`` characters (a
shorter item is one passage).  A passage of n characters that occurs with at most
e edits shares at least n - q + 1 - q*e q-grams with the place, on at most e + 1
neighbouring diagonals.  Shared q-grams are counted in bands of 2(e + 1)
diagonals, each band overlapping the next by half; bands that reach the bound are
verified by an alignment within the band.  The filter loses nothing: every laid
passage is found.  Passages begin every ``step`` characters and at the item's end, so
every verbatim quotation of window + step - 1 characters (99 by default) holds one
whole and is found, as is any shorter item that is quoted whole.

The passages are collected in blocks of at most ``block`` passages, whatever the
size of the benchmark; each block is one scan of the documents, so no task holds
more than one block's index.  Usually there is one block.

Null or empty document: nothing is found in it.  Null or blank item: no passage.
Passages shorter than q are searched as they are.  Rows of one doc_id are one
document, rows of one item_id one item.  Null ids are ids like any other.  Empty
table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.llm.worker import bounded_slices
from specflow.session import materialize

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
BITS = 22
SPAN = 1 << 40  # more than bands of a text
BEFORE = 1 << 20  # keeps diagonals positive
AT_ONCE = 1_000_000
HITS = "doc_id long, item_id long, begin_at long, end_at long, edits int"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Polynomial hash of every q characters, by doubling."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        power, width, done = codes, 1, None
        scale, done_width = _BASE, 0
        rest = q
        while rest:
            if rest & 1:
                if done is None:
                    done, done_width = power, width
                else:
                    n = len(codes) - done_width - width + 1
                    done, done_width = done[:n] * scale + power[done_width : done_width + n], done_width + width
            rest >>= 1
            if rest:
                n = len(codes) - 2 * width + 1
                power, width = power[:n] * scale + power[width : width + n], 2 * width
                scale = scale * scale
        return done


def passages_of(text: str | None, window: int, step: int) -> list[tuple[int, str]]:
    """(offset, passage): windows every ``step`` characters and one at the end."""
    text = normal(text)
    if not text:
        return []
    last = max(0, len(text) - window)
    starts = sorted({*range(0, last, step), last})
    return [(s, text[s : s + window]) for s in starts]


def build_index(passages: list[tuple[int | None, str]], q: int, rate: float) -> dict:
    """Sorted q-grams with their postings, edit budgets and thresholds: plain arrays, fit for a broadcast."""
    texts = [p for _, p in passages]
    lengths = np.array([len(p) for p in texts], np.int64)
    budget = np.maximum(0, np.minimum((rate * lengths).astype(np.int64), lengths // q - 1))
    hashes = [gram_hashes(codes_of(p), q) for p in texts]
    owner = np.repeat(np.arange(len(texts)), [len(h) for h in hashes])
    offset = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.empty(0, np.int64)
    hashed = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    order = np.argsort(hashed, kind="stable")
    keys, first, count = np.unique(hashed[order], return_index=True, return_counts=True)
    seen = np.zeros(1 << BITS, bool)
    with np.errstate(over="ignore"):
        seen[(keys * _MIX) >> np.uint64(64 - BITS)] = True
    return {
        "q": q, "items": [i for i, _ in passages], "texts": texts, "lengths": lengths, "budget": budget,
        "least": lengths - q + 1 - q * budget, "keys": keys, "first": first, "count": count,
        "owner": owner[order].astype(np.int32), "offset": offset[order].astype(np.int32), "seen": seen,
        "short": [k for k, p in enumerate(texts) if len(p) < q],
    }


def banded_edits(passage: np.ndarray, place: np.ndarray, width: int) -> tuple[int, int]:
    """Fewest edits that turn ``passage`` into a substring of ``place`` starting on one of the first ``width``
    diagonals and staying on them, and where that substring ends."""
    n = len(passage)
    far = n + width
    padded = np.full(n + width, -1, np.int64)
    padded[: min(len(place), n + width)] = place[: n + width].astype(np.int64)
    shift = np.arange(width)
    row = np.zeros(width, np.int64)
    for i in range(n):
        new = row + (padded[i : i + width] != np.int64(passage[i]))
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - shift) + shift
    best = int(row.argmin())
    return (int(row[best]), min(best + n, len(place))) if n else (far, 0)


def full_bands(index: dict, at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """passage * SPAN + band of the bands that reach their bound, from q-grams ``key`` at ascending places ``at``.

    Places are taken in stretches of about ``AT_ONCE`` shared q-grams, so a phrase common to many passages and
    texts needs no more memory.  The q-grams of a band lie within ``reach`` places; stretches overlap by as
    much and are at least twice as long, so every band is whole in one of them.
    """
    count = index["count"][key]
    reach = int((index["lengths"] + 2 * (index["budget"] + 1)).max())
    total = np.cumsum(count)
    begin, out = 0, [np.empty(0, np.int64)]
    while begin < len(at):
        enough = np.searchsorted(total, total[begin] + AT_ONCE, side="right")
        end = max(int(enough), int(np.searchsorted(at, at[begin] + 2 * reach, side="right")))
        some = count[begin:end]
        ends = np.cumsum(some)
        posting = np.arange(ends[-1]) - np.repeat(ends - some - index["first"][key[begin:end]], some)
        owner = index["owner"][posting].astype(np.int64)
        diagonal = np.repeat(at[begin:end], some) - index["offset"][posting] + BEFORE
        band = diagonal // (index["budget"][owner] + 1)
        bands = np.concatenate([owner * SPAN + band, owner * SPAN + band - 1])
        bands, shared = np.unique(bands, return_counts=True)
        out.append(bands[shared >= index["least"][bands // SPAN]])
        begin = len(at) if end >= len(at) else int(np.searchsorted(at, at[end] - reach))
    return np.unique(np.concatenate(out))


def search(index: dict, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text, passage, begin, end, edits) of every place found in normalised ``texts``."""
    q = index["q"]
    codes = codes_of("\0".join(texts) + "\0")
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    out = []
    for k in index["short"]:
        for t, text in enumerate(texts):
            at = text.find(index["texts"][k])
            if at >= 0:
                out.append((t, k, at, at + len(index["texts"][k]), 0))
    hashed = gram_hashes(codes, q)
    with np.errstate(over="ignore"):
        at = np.flatnonzero(index["seen"][(hashed * _MIX) >> np.uint64(64 - BITS)])
    if not len(at) or not len(index["keys"]):
        return out
    found = hashed[at]
    key = np.minimum(np.searchsorted(index["keys"], found), len(index["keys"]) - 1)
    same = index["keys"][key] == found
    at, key = at[same], key[same]
    done: dict[tuple[int, int], tuple] = {}
    for code in full_bands(index, at, key).tolist():
        k, b = divmod(code, SPAN)
        n, half = int(index["lengths"][k]), int(index["budget"][k]) + 1
        low = max(0, b * half - BEFORE)
        place = codes[low : low + n + 2 * half]
        passage = index["texts"][k]
        exact = place.astype("<u4").tobytes().decode("utf-32-le").find(passage)
        edits, end = (0, exact + n) if exact >= 0 else banded_edits(codes_of(passage), place, 2 * half)
        if edits > index["budget"][k]:
            continue
        middle = low + end - n // 2 - 1
        t = int(np.searchsorted(starts, middle, side="right")) - 1
        end = int(min(low + end, starts[t + 1] - 1) - starts[t])
        begin = max(0, end - n)
        if (t, k) not in done or edits < done[t, k][4]:
            done[t, k] = (t, k, begin, end, edits)
    return out + list(done.values())


def benchmark_blocks(benchmark: DataFrame, *, q: int, rate: float, window: int, step: int, block: int):
    """A broadcast index per block of the benchmark's passages."""
    spark = benchmark.sparkSession

    def cut(batches):
        for batch in batches:
            rows = [
                (item, passage)
                for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for _, passage in passages_of(text, window, step)
            ]
            columns = list(zip(*rows)) or [(), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string()))], names=["item_id", "passage"]
            )

    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    passages = materialize(items.mapInArrow(cut, "item_id long, passage string").distinct(), "passages")
    blocks = max(1, math.ceil(passages.count() / block))
    for k in range(blocks):
        some = passages.where(F.pmod(F.xxhash64("item_id", "passage"), F.lit(blocks)) == k).collect()
        some = sorted(((r.item_id, r.passage) for r in some), key=repr)  # about ``block`` passages of ``window`` letters
        yield spark.sparkContext.broadcast(build_index(some, q, rate))


SETTINGS = {"q": 12, "rate": 0.05, "window": 80, "step": 20, "block": 20_000}


def find_passages(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """doc_id, item_id, begin_at, end_at, edits per document and benchmark item found in it.

    Places count in the normalised text: first begin, last end and fewest edits of
    the item's passages.  Settings: q, rate (edits per character), window, step, block.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = None
    for index in benchmark_blocks(benchmark, **SETTINGS | settings):

        def scan(batches, index=index):
            known = index.value
            for batch in batches:
                doc_ids = batch.column(0).to_pylist()
                for a, b in bounded_slices(batch.column(1)):
                    hits = search(known, [normal(t) for t in batch.column(1)[a:b].to_pylist()])
                    rows = [(doc_ids[a + t], known["items"][p], begin, end, edits) for t, p, begin, end, edits in hits]
                    columns = list(zip(*rows)) or [()] * 5
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                        names=["doc_id", "item_id", "begin_at", "end_at", "edits"],
                    )

        hits = texts.mapInArrow(scan, HITS)
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy("doc_id", "item_id").agg(
        F.min("begin_at").alias("begin_at"), F.max("end_at").alias("end_at"), F.min("edits").alias("edits")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark passage."""
    at = docs.columns.index("text")
    for index in benchmark_blocks(benchmark, **SETTINGS | settings):

        def keep(batches, index=index):
            for batch in batches:
                for a, b in bounded_slices(batch.column(at)):
                    clean = np.ones(b - a, bool)
                    clean[[hit[0] for hit in search(index.value, [normal(t) for t in batch.column(at)[a:b].to_pylist()])]] = False
                    yield batch[a:b].filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
