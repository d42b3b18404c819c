"""Importance resampling towards a target distribution, ranked by a distributed radix sort.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z; features
are the words, repeats counted, and a feature's bucket is the crc32 of its UTF-8
bytes modulo ``buckets``.  A bucket's gain is the floor of 1000 times the log ratio
of its smoothed shares in the target and in all documents.  The gains are an array
of fixed size; a document's weight is the sum of the entries its features name.  A
Gumbel value drawn from the hash of ``seed:doc_id`` is added, and the documents with
the largest scores are a sample without replacement in proportion to the weights.

The order (score descending, doc_id ascending) comes from a least-significant-digit
radix sort over the digits of the composite key.  Every pass is one stable counting
sort over all rows: rows stand in blocks of consecutive places; occurrences of each
digit are counted per block; prefix sums over (digit, block) are the first place of
each block's share, and a row's place within its share completes its destination.
Digits in which all rows agree need no pass.  Blocks have a bounded number of rows
and no group is larger than a block, so equal scores or digits are no hot spot.
Passes are written, so a lost executor costs one pass.

Null text: no features, weight 0.  Null doc_id: hashed as the empty text, after all
others in ties.  Texts of any length are counted in portions.  Rows that repeat are
ranked one after the other.  Ties beyond (score, doc_id) keep some order.  Empty
table: empty result; empty target: all its counts are zero.  Other columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specflow.llm.worker import bounded_slices, kept
from specflow.session import materialize

BUCKETS = 10_000
SCALE = 1000
DIGIT = 10
BLOCK_ROWS = (1 << 10, 1 << 20)  # fewest and most rows of a block
PORTION = 4_000_000
_REMEMBERED = 1_000_000
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_in(text: str | None):
    """Lists of the words of a text as bytes, a bounded portion at a time."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)
    begin = 0
    while begin < len(raw):
        end = begin + PORTION
        if end < len(raw):
            cut = raw.find(b" ", end)
            end = len(raw) if cut < 0 else cut
        yield raw[begin:end].split()
        begin = end


class _Buckets(dict):
    """word -> bucket, remembered."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        self[word] = at = crc32(word) % self.buckets
        return at


def _buckets(buckets: int) -> _Buckets:
    remembered = kept("feature_buckets", dict).setdefault(buckets, _Buckets(buckets))
    if len(remembered) > _REMEMBERED:
        remembered.clear()
    return remembered


def bucket_counts(texts: DataFrame, *, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of all features of ``texts`` (text) by bucket.

    A task hands on one row per bucket it met; one row per bucket reaches the driver.
    """

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for a, b in bounded_slices(batch.column(0)):
                seen: Counter = Counter()
                for text in batch.column(0)[a:b]:
                    for words in words_in(text.as_py()):
                        seen.update(words)
                place = _buckets(buckets)
                at = np.fromiter(map(place.__getitem__, seen), np.int64, len(seen))
                np.add.at(total, at, np.fromiter(seen.values(), np.int64, len(seen)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    parts = texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floor of 1000 times the log ratio of the smoothed shares, per bucket."""
    n, total, wanted = len(source), int(source.sum()), int(target.sum())
    ratio = [(int(t) + 1) * (total + n) / ((int(s) + 1) * (wanted + n)) for s, t in zip(source, target)]
    return np.array([math.floor(SCALE * math.log(r)) for r in ratio], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_features, weight per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def run(batches):
        gain = shared.value
        for batch in batches:
            for a, b in bounded_slices(batch.column(1)):
                place = _buckets(len(gain))
                n, weight = [], []
                for text in batch.column(1)[a:b]:
                    count = total = 0
                    for words in words_in(text.as_py()):
                        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                        count += len(at)
                        total += int(gain[at].sum())
                    n.append(count)
                    weight.append(total)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                    names=["doc_id", "n_features", "weight"],
                )

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id long, n_features long, weight long")


def gumbel(doc_id: Column | str, seed: int) -> Column:
    """Floor of 1000 times a Gumbel value fixed by the first 32 bits of sha256 of ``seed:doc_id``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(name, 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _from_zero(name: str, least: int, most: int) -> Column:
    """The longs of a column as non-negative distances from the smallest, or as unsigned bits if those don't fit."""
    if most - least < 1 << 63:
        return F.col(name) - F.lit(least).cast("long")
    return F.col(name).bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


def radix_ranks(rows: DataFrame, keys: list[Column], *, digit_bits: int = DIGIT, block_rows: int | None = None) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3 ... in ascending order of ``keys`` (longs without nulls, first key first).

    Every pass is written.  ``block_rows`` (a power of two) is the size of a block;
    by default a fraction of the table within ``BLOCK_ROWS``.
    """
    spark = rows.sparkSession
    names = [f"__key{i}" for i in range(len(keys))]
    columns = rows.columns
    state = rows.select(*columns, *[k.alias(n) for k, n in zip(keys, names)])
    state = materialize(state.withColumn("__place", F.monotonically_increasing_id()), "radix-input")
    span = state.agg(F.count(F.lit(1)).alias("n"), *[f(n).alias(f"{f.__name__}{n}") for n in names for f in (F.min, F.max)]).first()
    ends = {n: (span[f"min{n}"] or 0, span[f"max{n}"] or 0) for n in names}
    if block_rows is None:
        each = span.n // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
        block_rows = 1 << min(max(each, BLOCK_ROWS[0]), BLOCK_ROWS[1]).bit_length() - 1
    shift = block_rows.bit_length() - 1
    mask = F.lit((1 << digit_bits) - 1).cast("long")
    # digits in which all rows agree keep every row where it is
    digits = [(n, low) for n in reversed(names) for low in range(0, (ends[n][1] - ends[n][0]).bit_length(), digit_bits)]
    for name, low in digits or [(names[0], 0)]:  # one pass at least, to close the gaps between places
        block = F.shiftright("__place", shift).alias("__block")
        digit = F.shiftrightunsigned(_from_zero(name, *ends[name]), low).bitwiseAND(mask).cast("int").alias("__digit")
        counts = state.groupBy(block, digit).agg(F.count(F.lit(1)).alias("__n"))
        # first place of a digit: all smaller digits; of a block's share: the same digit in earlier blocks
        totals = counts.groupBy("__digit").agg(F.sum("__n").alias("__all"))
        before = Window.orderBy("__digit").rowsBetween(Window.unboundedPreceding, -1)  # at most 2 ** digit_bits rows
        totals = totals.select("__digit", F.coalesce(F.sum("__all").over(before), F.lit(0)).alias("__first"))
        earlier = Window.partitionBy("__digit").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        shares = counts.select("__digit", "__block", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
        starts = shares.join(F.broadcast(totals), "__digit").select(
            F.col("__digit").alias("__d"), F.col("__block").alias("__b"), (F.col("__before") + F.col("__first")).alias("__start")
        )
        # rows of one block and digit keep their order; no such group is larger than a block
        share = Window.partitionBy("__block", "__digit").orderBy("__place")
        placed = state.select("*", block, digit).withColumn("__nth", F.row_number().over(share) - 1)
        same = (F.col("__block") == F.col("__b")) & (F.col("__digit") == F.col("__d"))
        moved = placed.join(starts.hint("merge"), same).withColumn("__place", F.col("__start") + F.col("__nth"))
        state = materialize(moved.select(*columns, *names, "__place"), "radix-pass")
    return state.select(*columns, (F.col("__place") + 1).alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    share: tuple[int, int] = (10, 100),
    least_words: int = 20,
    seed: int = 2024,
    buckets: int = BUCKETS,
    **sorting,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank per row of ``docs``; ``rank`` is null for rows not drawn.

    Of the rows with at least ``least_words`` features the floor of ``share`` of
    them with the highest scores is drawn.
    """
    gain = gains(bucket_counts(docs, buckets=buckets), bucket_counts(target, buckets=buckets))
    scored = weigh(docs, gain)
    scored = scored.withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    scored = materialize(scored, "weights")
    some = scored.where(F.col("n_features") >= least_words)
    ranked = radix_ranks(
        some,
        [
            F.bitwise_not("score"),
            F.col("doc_id").isNull().cast("long"),
            F.coalesce("doc_id", F.lit(0).cast("long")),
        ],
        **sorting,
    )
    drawn = some.count() * share[0] // share[1]
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(F.col("n_features") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


ORACLE = r"""
WITH table256 AS (
  SELECT list(v ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n::UBIGINT] || [0::UBIGINT FOR _ IN range(8)], lambda c, _z:
      CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) r(n))
),
texts AS (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
words AS (
  SELECT side, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts
),
tally AS (SELECT side, id, w, count(*) AS n FROM words GROUP BY ALL),
hashed AS (
  SELECT w, xor(4294967295::UBIGINT, list_reduce([4294967295::UBIGINT] || [('0x' || hex(encode(w))[2 * i + 1 : 2 * i + 2])::UBIGINT FOR i IN range(strlen(w))],
    lambda c, b: xor(t[((xor(c, b) & 255) + 1)::BIGINT], c >> 8))) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM tally), table256
),
counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t
  FROM tally JOIN hashed USING (w) GROUP BY bucket
),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM counts) + 10000) / ((s + 1) * ((SELECT sum(t) FROM counts) + 10000))))::BIGINT AS g
  FROM counts
),
weights AS (
  SELECT id AS doc_id, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight
  FROM tally JOIN hashed USING (w) JOIN gain USING (bucket) WHERE side = 0 GROUP BY id
),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weights USING (doc_id)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    (SELECT count(*) FROM scored WHERE n_features >= 20) AS eligible
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank FROM ranked
"""
