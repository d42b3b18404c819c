"""Token ids in patched frame-of-reference blocks.

A shard is one byte string: header, document index, block index, blocks.  Ids of
all its documents are cut into blocks of 256.  A block keeps its minimum, packs
the differences at a width that holds a chosen percentile of them, and lists the
others (position, whole difference) as exceptions.  The block index holds the
place of each block, so any run of ids can be read on its own.

Layout (little endian)::

    "PFR1"  u32 documents  u64 ids  u32 blocks
    documents x (i64 doc_id, u8 has_id, u32 ids)
    (blocks + 1) x u32 place of a block within the block area
    block: u32 minimum, u8 width, u8 0, u16 exceptions, 32*width bytes,
           exceptions x u8 position, exceptions x u32 difference

``write_token_blocks`` orders documents by doc_id over range partitions and lets
Spark's writer commit the shards as rows (part, seq, before, n_ids, shard), so a
lost executor leaves no half file.  A shard closes after ``shard_ids`` ids at a
document's end.

Null text: no ids but the end id.  Null doc_id: sorts first, read back as null.
Equal doc_ids: each row is a document of its own, ordered by a hash of the text.
Empty table: no shards, empty result.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specflow.llm.tokens import DEFAULT_TOKENIZER, encoder
from specflow.llm.worker import bounded_slices
from specflow.session import partitions_for

BLOCK = 256
MAGIC = b"PFR1"
_DOC = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("n", "<u4")])
_HEAD = np.dtype([("minimum", "<u4"), ("width", "u1"), ("zero", "u1"), ("exceptions", "<u2")])

SHARDS = "part int, seq int, before long, n_ids long, shard binary"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long, part int"


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits needed for each value, 0 for 0."""
    return np.where(values > 0, np.floor(np.log2(np.maximum(values, 1))).astype(np.int64) + 1, 0)


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for every count, end to end."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def encode_shard(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, percentile: float = 0.9) -> bytes:
    """One shard from the ids of its documents, end to end."""
    blocks = -(-len(ids) // BLOCK)
    padded = np.full(blocks * BLOCK, ids[-1] if len(ids) else 0, np.uint32)
    padded[: len(ids)] = ids
    padded = padded.reshape(blocks, BLOCK)
    low = padded.min(axis=1) if blocks else np.empty(0, np.uint32)
    diff = padded - low[:, None]
    rank = min(BLOCK - 1, int(percentile * BLOCK))
    width = _bits(np.partition(diff, rank, axis=1)[:, rank]) if blocks else np.empty(0, np.int64)
    outside = (diff.astype(np.uint64) >> width[:, None].astype(np.uint64)) > 0
    found = outside.sum(axis=1)
    sizes = _HEAD.itemsize + width * (BLOCK // 8) + found * 5
    places = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    body = np.zeros(places[-1], np.uint8)
    head = np.zeros(blocks, _HEAD)
    head["minimum"], head["width"], head["exceptions"] = low, width, found
    if blocks:
        body[places[:-1, None] + np.arange(_HEAD.itemsize)] = head.view(np.uint8).reshape(blocks, -1)
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        kept = diff[at] & np.uint32((1 << int(w)) - 1)
        bits = ((kept[:, :, None] >> np.arange(w, dtype=np.uint32)) & 1).astype(np.uint8)
        packed = np.packbits(bits.reshape(len(at), -1), axis=1, bitorder="little")
        body[places[at][:, None] + _HEAD.itemsize + np.arange(packed.shape[1])] = packed
    row, position = np.nonzero(outside)
    if len(row):
        nth = _ranges(found)
        base = places[row] + _HEAD.itemsize + width[row] * (BLOCK // 8)
        body[base + nth] = position
        value = diff[row, position].astype("<u4").view(np.uint8).reshape(-1, 4)
        body[(base + found[row] + 4 * nth)[:, None] + np.arange(4)] = value
    index = np.zeros(len(counts), _DOC)
    index["doc_id"] = [d or 0 for d in doc_ids]
    index["has_id"] = [d is not None for d in doc_ids]
    index["n"] = counts
    start = np.array([len(counts)], "<u4").tobytes() + np.array([len(ids)], "<u8").tobytes() + np.array([blocks], "<u4").tobytes()
    return b"".join([MAGIC, start, index.tobytes(), places.astype("<u4").tobytes(), body.tobytes()])


def _open(shard: bytes) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    if shard[:4] != MAGIC:
        raise ValueError("not a token shard")
    documents = int(np.frombuffer(shard, "<u4", 1, 4)[0])
    n = int(np.frombuffer(shard, "<u8", 1, 8)[0])
    blocks = int(np.frombuffer(shard, "<u4", 1, 16)[0])
    index = np.frombuffer(shard, _DOC, documents, 20)
    at = 20 + index.nbytes
    places = np.frombuffer(shard, "<u4", blocks + 1, at).astype(np.int64)
    body = np.frombuffer(shard, np.uint8, offset=at + 4 * (blocks + 1))
    if len(body) != places[-1] or int(index["n"].astype(np.int64).sum()) != n or blocks != -(-n // BLOCK):
        raise ValueError("damaged token shard")
    return index, n, places, body


def _decode(places: np.ndarray, body: np.ndarray) -> np.ndarray:
    """All ids of the blocks that ``places`` bound."""
    blocks = len(places) - 1
    if not blocks:
        return np.empty(0, np.uint32)
    head = body[places[:-1, None] + np.arange(_HEAD.itemsize)].reshape(-1).view(_HEAD)
    width, found = head["width"].astype(np.int64), head["exceptions"].astype(np.int64)
    diff = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        packed = body[places[at][:, None] + _HEAD.itemsize + np.arange(w * (BLOCK // 8))]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(at), BLOCK, w)
        value = np.zeros((len(at), BLOCK), np.uint32)
        for k in range(w):
            value |= bits[:, :, k].astype(np.uint32) << np.uint32(k)
        diff[at] = value
    row = np.repeat(np.arange(blocks), found)
    if len(row):
        nth = _ranges(found)
        base = places[row] + _HEAD.itemsize + width[row] * (BLOCK // 8)
        value = body[(base + found[row] + 4 * nth)[:, None] + np.arange(4)].reshape(-1).view("<u4")
        diff[row, body[base + nth]] = value
    return (diff + head["minimum"][:, None]).reshape(-1)


def decode_shard(shard: bytes) -> tuple[list[int | None], list[int], np.ndarray]:
    """doc_ids, ids per document and all ids."""
    index, n, places, body = _open(shard)
    doc_ids = [int(d) if has else None for d, has in zip(index["doc_id"], index["has_id"])]
    return doc_ids, index["n"].tolist(), _decode(places, body)[:n]


def read_run(shard: bytes, start: int, count: int) -> np.ndarray:
    """``count`` ids from place ``start``, decoding only the blocks that hold them."""
    _, n, places, body = _open(shard)
    stop = min(n, start + count)
    first = start // BLOCK
    ids = _decode(places[first : -(-stop // BLOCK) + 1], body)
    return ids[start - first * BLOCK : stop - first * BLOCK]


def write_token_blocks(
    docs: DataFrame,
    path: str,
    *,
    tokenizer: str = DEFAULT_TOKENIZER,
    end_id: int = 0,
    percentile: float = 0.9,
    shard_ids: int = 1 << 20,
) -> None:
    """Encode ``docs`` (doc_id, text) and write shards below ``path``, documents in doc_id order."""
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        part = TaskContext.get().partitionId()
        seq = before = size = 0
        names, counts, parts = [], [], []

        def close():
            nonlocal seq, before, size, names, counts, parts
            ids = np.frombuffer(b"".join(parts), "<u4")
            shard = encode_shard(names, counts, ids, percentile)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([shard], pa.binary())],
                names=["part", "seq", "before", "n_ids", "shard"],
            )
            seq, before, size, names, counts, parts = seq + 1, before + len(ids), 0, [], [], []
            return row

        code = encoder(tokenizer)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in bounded_slices(texts):
                for doc_id, ids in zip(doc_ids[a:b], code.encode(texts[a:b].to_pylist())):
                    names.append(doc_id)
                    parts.append(ids + end)
                    counts.append(len(ids) // 4 + 1)
                    size += counts[-1]
                    if size >= shard_ids:
                        yield close()
        if names:
            yield close()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(partitions_for(docs), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
    )
    ordered.mapInArrow(encode, SHARDS).write.mode("error").parquet(path)


def read_token_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the shards: doc_id, start, n_tokens, ids_crc32.

    Only one total per writing task reaches the driver.
    """

    def decode(batches):
        for batch in batches:
            for part, before, shard in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                doc_ids, counts, ids = decode_shard(shard.as_py())
                stops = list(accumulate(counts))
                whole = memoryview(ids.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array([before + stop - n for stop, n in zip(stops, counts)], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([zlib.crc32(whole[4 * (s - n) : 4 * s]) for s, n in zip(stops, counts)], pa.int64()),
                        pa.array([part] * len(counts), pa.int32()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "part"],
                )

    shards = spark.read.schema(SHARDS).parquet(path)
    totals = sorted(shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    bases = list(accumulate((t.n for t in totals), initial=0))
    base = spark.createDataFrame([(t.part, b) for t, b in zip(totals, bases)], "part int, base long")
    # one row per writing task
    rows = shards.select("part", "before", "shard").mapInArrow(decode, DOCUMENTS).join(F.broadcast(base), "part")
    return rows.select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
