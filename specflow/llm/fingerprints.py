"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the ``k`` smallest distinct hashes of a text's ``width``-word
shingles (words are runs of anything but ASCII blanks, as they are; fewer words
than ``width`` are one shingle).  A hash is the upper 48 bits of the XXH64 of the
space-joined UTF-8 shingle.  A sketch with fewer than ``k`` hashes is the whole
set.  The smallest hashes of a union are among the smallest of its parts, so
sketches of parts merge into the sketch of the whole, in any order; long texts
are hashed in portions that way, and ``merge_parts`` does it for tables.

Up to the smaller of the two last hashes (or all, if a sketch is a whole set) both
sketches are complete samples of their sets, so resemblance and containment are
shares of the hashes below that limit, and set sizes follow from its height.

As text a sketch is base64 of ``k`` (two bytes) and the ascending hashes (six
bytes each), all little-endian; equal texts have equal fingerprints.

Null, empty or blank text: the empty sketch, which resembles another empty one
fully and nothing else; it is contained in everything.  Very long texts need the
memory of the text and of one portion.  Rows that repeat are treated alike.  Empty
table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specflow.llm.worker import bounded_slices
from specflow.session import partitions_for

K = 256
WIDTH = 5
SEED = 42
BITS = 48
PORTION = 50_000  # shingles hashed at once
HELD = 2_000  # keys whose partial sketches a task holds before it hands them on
FAN_IN = 64
_BLANK = re.compile(rb"[^\x20\x09-\x0D]+")


def smallest(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of a set of hashes; of concatenated sketches, their merge."""
    return np.unique(hashes)[:k]


def sketch(text: str | None, k: int = K, width: int = WIDTH) -> np.ndarray:
    """Ascending smallest hashes of the shingles of a text."""
    from xxhash import xxh64_intdigest

    held, words = np.empty(0, np.uint64), []

    def fold(words: list[bytes], n: int) -> None:
        nonlocal held
        hashes = [xxh64_intdigest(b" ".join(words[i : i + width]), SEED) for i in range(n)]
        held = smallest(np.concatenate([held, np.array(hashes, np.uint64) >> np.uint64(64 - BITS)]), k)

    raw = (text or "").encode("utf-8", "surrogatepass")
    if len(raw) <= 8 * PORTION:
        words = raw.split()
    else:
        for match in _BLANK.finditer(raw):  # no list of all words of a long text
            words.append(match[0])
            if len(words) == PORTION + width - 1:
                fold(words, PORTION)
                del words[:PORTION]
        if len(words) < width and len(held):
            return held
    if words:
        fold(words, max(1, len(words) - width + 1))
    return held


def to_text(hashes: np.ndarray, k: int = K) -> str:
    eight = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    return base64.b64encode(k.to_bytes(2, "little") + eight[:, : BITS // 8].tobytes()).decode()


def from_text(fingerprint: str) -> tuple[np.ndarray, int]:
    """(hashes, k) of a fingerprint."""
    raw = base64.b64decode(fingerprint)
    eight = np.zeros(((len(raw) - 2) // 6, 8), np.uint8)
    eight[:, :6] = np.frombuffer(raw, np.uint8, offset=2).reshape(-1, 6)
    return eight.view("<u8").reshape(-1).astype(np.uint64), int.from_bytes(raw[:2], "little")


def _common(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int, int]:
    """Hashes of a, of b and of both below the limit up to which both sketches are complete."""
    limit = min(a[-1] if len(a) >= k else 1 << BITS, b[-1] if len(b) >= k else 1 << BITS)
    a, b = a[: np.searchsorted(a, limit, "right")], b[: np.searchsorted(b, limit, "right")]
    return len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the shingles of both texts among those of either."""
    n, m, both = _common(a, b, k)
    return both / (n + m - both) if n + m else 1.0


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has too."""
    n, _, both = _common(a, b, k)
    return both / n if n else 1.0


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(len(a)) if len(a) < k else (k - 1) * float(1 << BITS) / (float(a[-1]) + 1)


def _estimate(func):
    """A column function of two fingerprints; sketches of different k compare at the smaller one."""

    def one(x: str | None, y: str | None) -> float | None:
        if x is None or y is None:
            return None
        (x, k), (y, other) = from_text(x), from_text(y)
        k = min(k, other)
        return func(x[:k], y[:k], k)

    @F.pandas_udf("double")
    def estimate(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")

    return estimate


def resemblance_of(a: Column | str, b: Column | str) -> Column:
    """Estimated resemblance of two fingerprint columns; null if one is null."""
    return _estimate(resemblance)(a, b)


def containment_of(a: Column | str, b: Column | str) -> Column:
    """Estimated containment of the first fingerprint's text in the second's; null if one is null."""
    return _estimate(containment)(a, b)


def distinct_count_of(a: Column | str) -> Column:
    """Estimated number of distinct shingles behind a fingerprint column; null if null."""
    return _estimate(lambda x, _, k: distinct_count(x, k))(a, a)


def fingerprint_documents(docs: DataFrame, *, k: int = K, width: int = WIDTH) -> DataFrame:
    """doc_id, fingerprint per row of ``docs``, without a shuffle."""

    def run(batches):
        for batch in batches:
            prints = [to_text(sketch(t.as_py(), k, width), k) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id long, fingerprint string")


def merge_parts(parts: DataFrame, by: str, fingerprint: str = "fingerprint") -> DataFrame:
    """One fingerprint per value of ``by``: that of all its parts together.

    Tasks merge what they read before anything moves, and partial sketches of one
    key meet in ``FAN_IN`` salted groups first, so a key that holds a third of all
    rows is many small merges.  Null keys are one key; null fingerprints are left out.
    """
    kind = parts.schema[by].dataType.simpleString()

    def fold(held: dict, key, hashes: np.ndarray, k: int) -> None:
        if key in held:
            before, least = held[key]
            k = min(k, least)
            hashes = np.concatenate([before, hashes])
        held[key] = smallest(hashes, k), k

    def out(held: dict, schema: pa.Schema) -> pa.RecordBatch:
        texts = [to_text(h, k) for h, k in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(held), schema.field(0).type), pa.array(texts, pa.string())], names=["key", "part"])

    def local(batches):
        held: dict = {}
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fold(held, key, *from_text(text))
            if len(held) > HELD:
                yield out(held, batch.schema)
                held = {}
        if held:
            yield out(held, batch.schema)

    def runs(batches):  # rows of one key follow each other
        held, schema = {}, None
        for batch in batches:
            schema = batch.schema
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and key not in held:
                    yield out(held, schema)
                    held = {}
                fold(held, key, *from_text(text))
        if held:
            yield out(held, schema)

    given = parts.select(F.col(by).alias("key"), F.col(fingerprint).alias("part")).where("part IS NOT NULL")
    given = given.mapInArrow(local, f"key {kind}, part string")
    salted = given.withColumn("salt", F.pmod(F.xxhash64("part"), F.lit(FAN_IN)))
    salted = salted.repartition("key", "salt").sortWithinPartitions("key", "salt").select("key", "part")
    salted = salted.mapInArrow(runs, f"key {kind}, part string")
    merged = salted.repartition("key").sortWithinPartitions("key").mapInArrow(runs, f"key {kind}, part string")
    return merged.select(F.col("key").alias(by), F.col("part").alias("fingerprint"))


def _with_successors(docs: DataFrame) -> DataFrame:
    """Rows (part, ghost, doc_id, text) in which a part is one run of descending doc_id, closed by its ``ghost``.

    A part is the rows between two actual doc_ids found as quantiles, so its first
    rows are known by their doc_id; copies of them are the ghost of the part before
    (of the last part for the largest doc_id).  The texts move once.  Rows without
    doc_id are spread over parts of their own, which have no ghost.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    spread = partitions_for(rows)
    parts = 4 * spread  # several runs a task even out
    shares = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 20 * parts).alias("cuts"), F.max("doc_id").alias("top")).first()
    cuts = np.array(sorted({*(found.cuts or ()), found.top} - {None}), np.int64)
    last = len(cuts)

    @F.pandas_udf("int")
    def part_of(doc_id: pd.Series) -> pd.Series:  # 0 holds the largest doc_ids
        at = np.searchsorted(cuts, doc_id.to_numpy(np.int64), side="left")
        return pd.Series((last - 1 - at).astype(np.int32))

    known = rows.where("doc_id IS NOT NULL").withColumn("part", part_of("doc_id"))
    before = F.when(F.col("part") == 0, F.lit(last - 1)).otherwise(F.col("part") - 1)
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("ghost"))
    ghost = F.struct(before.alias("part"), F.lit(True).alias("ghost"))
    opens = F.col("doc_id").isin(*cuts.tolist()) if last else F.lit(False)
    known = known.select("doc_id", "text", F.explode(F.when(opens, F.array(own, ghost)).otherwise(F.array(own))).alias("at"))
    lone = rows.where("doc_id IS NULL").select("*", F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int").alias("salt"))
    lone = lone.select(F.struct((F.lit(last) + F.col("salt")).alias("part"), F.lit(False).alias("ghost")).alias("at"), "doc_id", "text")
    placed = known.unionByName(lone).select("at.part", "at.ghost", "doc_id", "text", F.xxhash64("text").alias("tie"))
    order = ["part", "ghost", F.col("doc_id").desc(), "tie"]
    return placed.repartition(spread, "part").sortWithinPartitions(*order).select("part", "ghost", "doc_id", "text")


def edited(text: str, following: str) -> str:
    """``text`` whose last half (rounded down) gives way to the beginning of ``following``, as long or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, *, k: int = K, width: int = WIDTH) -> DataFrame:
    """Each text against an edited copy of itself and against the next document by descending doc_id.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next (estimated resemblances) per row; after the last document comes the
    first.  Rows of one doc_id follow each other by the hash of their text, and lie
    in one part; a row without doc_id is its own next document.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compare(doc_id, text, own, following, its):
        changed = edited(text, following)
        other = sketch(changed, k, width)
        digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return (
            doc_id, len(text), digest, to_text(own, k), to_text(other, k), resemblance(own, other, k), resemblance(own, its, k),
        )

    def run(batches):
        held = None  # part, doc_id, text and sketch of the row that waits for its next
        for batch in batches:
            for a, b in bounded_slices(batch.column(3)):
                rows = []
                for part, ghost, doc_id, text in zip(*[c.to_pylist() for c in batch[a:b].columns]):
                    if ghost and (held is None or held[0] != part):
                        continue  # only the first ghost is the next document
                    own = sketch(text, k, width)
                    if held is not None:
                        rows.append(compare(*held[1:], text, own))
                    held = None if ghost else (part, doc_id, text, own)
                    if doc_id is None:
                        rows.append(compare(*held[1:], text, own))
                        held = None
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _with_successors(docs).mapInArrow(run, schema)
