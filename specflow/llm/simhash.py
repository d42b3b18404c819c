"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint is eight bytes at eight positions.  Two fingerprints that differ in
at most ``max_bits`` = 3 bits share at least 8 - 3 = 5 positional bytes.  Lists
of single bytes would hold a 256th of all fingerprints each, so the index keys
are three positional bytes of one half: five shared bytes put at least three in
one half, so each such pair meets in one of the eight lists.  Within a list the
shared positional bytes of a pair are tallied, pairs below the guaranteed five
are dropped, and the rest are verified bit by bit.

Exact copies are one fingerprint, and a list hands on only a spanning forest of
its links, so groups of copies cost rows in proportion to their size.

Null or empty text, or text without words: fingerprint zero, linked like any
other.  Rows of one doc_id are one document: their fingerprints are linked, however
far apart.  Rows without doc_id link nothing and get the component of their
fingerprint's other rows, else null.  Ties cannot occur: a component is named by its
smallest doc_id.  Empty table: empty result.  Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.llm import buckets
from specflow.llm.components import connected_components
from specflow.llm.worker import unused
from specflow.session import materialize

POSITIONS = 8
TRIPLES = [(0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3), (4, 5, 6), (4, 5, 7), (4, 6, 7), (5, 6, 7)]
SEED = 42
SHINGLES = 50_000  # hashed at once


def simhash(text: str | None, width: int = 3) -> int:
    """Majority of the bits of the XXH64 of every ``width``-word shingle."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII blanks
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES):
        some = range(at, min(n, at + SHINGLES))
        hashes = np.array([xxh64_intdigest(b" ".join(words[i : i + width]), SEED) for i in some], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    ones = counts * 2 > n
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, width: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a long), tie (a hash of the text) per row."""

    def fold(batches):
        for batch in batches:
            prints = [simhash(t.as_py(), width) for t in batch.column(1)]
            fp = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp, batch.column(2)], names=["doc_id", "fp", "tie"])

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("tie"))
    return chosen.mapInArrow(fold, "doc_id long, fp long, tie long")


def near_links(prints: DataFrame, *, max_bits: int = 3, chunk: int = 1024) -> DataFrame:
    """prints (node, fp), all fp distinct -> links (a, b) that connect what lies within ``max_bits``."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the index finds up to 3 differing bits")

    def byte(position: int):
        return F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(255).cast("long"))

    keys = [
        F.lit(k << 24).cast("long") + byte(x) * 65536 + byte(y) * 256 + byte(z) for k, (x, y, z) in enumerate(TRIPLES)
    ]
    postings = prints.select("node", "fp", F.explode(F.array(*keys)).alias("bucket"))

    def verify(batches):
        for starts, crossed, (node, fp, side) in buckets.runs(batches, ["node", "fp", "side"]):
            node, fp, side = node.to_numpy(), fp.to_numpy().view(np.uint64), side.to_numpy(zero_copy_only=False)
            least = POSITIONS - max_bits

            def linked(a, b):
                differ = fp[a] ^ fp[b]
                octets = differ.view(np.uint8).reshape(-1, POSITIONS)
                shared = (octets == 0).sum(axis=1)
                return (shared >= least) & (np.bitwise_count(differ) <= max_bits)

            forest = buckets.Forest(len(fp))
            for a, b in buckets.pairs(starts, crossed, side, len(fp), linked):
                forest.join(a, b)
            a, b = forest.links()
            yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    return buckets.cells(postings, "node", chunk=chunk).mapInArrow(verify, "a long, b long")


def _same_document(prints: DataFrame, distinct: DataFrame) -> DataFrame:
    """Links (a, b) between the fingerprints of each doc_id that has several."""
    several = prints.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
    several = materialize(several.where("least <> most").select("doc_id"), "repeated-documents")
    own = prints.select("doc_id", "fp").join(several.hint("merge"), "doc_id").distinct()
    return own.join(distinct.hint("merge"), "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))


def _components(docs: DataFrame, width: int, max_bits: int, chunk: int, by_document: bool) -> DataFrame:
    """doc_id, fp, tie, component_id per row; with ``by_document`` all rows of a doc_id are in one component."""
    prints = materialize(fingerprints(docs, width=width), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct-fingerprints")
    links = near_links(distinct.where("node IS NOT NULL"), max_bits=max_bits, chunk=chunk)
    if by_document:
        links = links.unionByName(_same_document(prints, distinct))
    component = connected_components(links, "a", "b")
    named = distinct.join(component, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    named = materialize(named, "fingerprint-components")
    return prints.join(named.hint("merge"), "fp")


def near_duplicates(docs: DataFrame, *, width: int = 3, max_bits: int = 3, chunk: int = 1024) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id per row of ``docs``."""
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return _components(docs, width, max_bits, chunk, True).select("doc_id", hexed, "component_id")


def keep_first(docs: DataFrame, *, width: int = 3, max_bits: int = 3, chunk: int = 1024) -> DataFrame:
    """``docs`` without the rows that are near a row of a smaller doc_id, directly or through others.

    Rows go one by one: of a doc_id with several texts each stays or goes with the
    texts near it, so every group of near texts keeps a row.  Rows without doc_id stay.
    """
    groups = _components(docs, width, max_bits, chunk, False)
    doc, tie = unused(docs, "__gone", "__tie")
    gone = groups.where("doc_id != component_id").select(F.col("doc_id").alias(doc), F.col("tie").alias(tie)).distinct()
    gone = materialize(gone, "near-duplicates")
    same = (F.col("doc_id").cast("long") == F.col(doc)) & (F.xxhash64("text") == F.col(tie))
    return docs.join(gone.hint("merge"), same, "left_anti")
