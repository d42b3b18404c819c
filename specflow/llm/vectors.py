"""Near-duplicate embeddings by cross-polytope hashing with verified pairs.

A vector is rotated three times by random signs and a fast Hadamard transform;
its cross-polytope hash is the axis, with sign, of the largest coordinate.  A few
such hashes make a bucket of one of several tables.  Multiprobe also posts a
vector under the second-largest axis of one of the hashes.  Members of a bucket
are compared by cosine in double precision.

The number of hashes grows with the logarithm of the number of vectors, so that a
bucket of unrelated vectors stays small, and the number of tables with it, so that
a pair at cosine 0.95 is missed about once in a million.  Buckets are found from
ids and bucket numbers alone; vectors travel only to buckets of several members.

Equal vectors are one member with a multiplicity.  A pair that meets in several
buckets counts in the first common one only, so links are counted inside the tasks
and no list of pairs exists; a bucket hands on link counts and a spanning forest.

Vectors that are null, zero, or hold null or non-finite components, and rows
without vec_id, link with nothing: n_links 0, their own component, kept.
Vectors of different lengths never link.  Rows that repeat a vec_id count as
vectors of their own, but those that can link share a component.  Ties cannot occur: components are
named by the smallest vec_id.  Empty table: empty result.  Other columns are
ignored.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.llm import buckets
from specflow.llm.components import connected_components
from specflow.session import materialize

# tables by number of hashes: measured share of pairs at cosine 0.95 that meet in one table (64
# coordinates) is 0.80, 0.67, 0.53 and 0.41
TABLES = {2: 9, 3: 13, 4: 18, 5: 26}
MEMBERS = 16
_ODD = np.uint64(0x9E3779B97F4A7C15)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(d)


def functions_for(vectors: int, length: float) -> int:
    """Fewest hashes whose buckets hold at most about ``MEMBERS`` of so many unrelated vectors."""
    axes = 2 << max(1, (max(1, round(length)) - 1).bit_length())
    return next((k for k in TABLES if MEMBERS * axes**k >= vectors), max(TABLES))


def bucket_keys(vectors: np.ndarray, functions: int, tables: int, seed: int = 11) -> np.ndarray:
    """(vectors, tables, functions + 1) bucket numbers of 32 bits within their table, of unit vectors of one length."""
    n, d = vectors.shape
    width = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :d] = vectors
    out = np.empty((n, tables, functions + 1), np.uint32)
    rows = np.arange(n)
    for table in range(tables):
        codes = np.zeros((functions + 1, n), np.uint64)
        for function in range(functions):
            signs = np.random.default_rng([seed, d, table, function]).choice([-1.0, 1.0], (3, width))
            x = padded
            for s in signs:
                x = hadamard(x * s)
            size = np.abs(x)
            first = size.argmax(axis=1)
            size[rows, first] = -1
            second = size.argmax(axis=1)
            for probe in range(functions + 1):
                axis = second if probe == function + 1 else first
                with np.errstate(over="ignore"):
                    codes[probe] = codes[probe] * _ODD + (2 * axis + (x[rows, axis] < 0) + 1).astype(np.uint64)
        with np.errstate(over="ignore"):
            out[:, table] = (codes * _ODD >> np.uint64(32)).T  # equal numbers of different axes only share a bucket
    return out


def packed(x: np.ndarray) -> bytes:
    """A vector as bytes: in single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        single = x.astype("<f4")
    return b"f" + single.tobytes() if (single == x).all() else b"d" + x.astype("<f8").tobytes()


def unpacked(raw: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors in double precision) for each kind and length of vector."""
    kinds = np.array([len(r) * 2 + (r[:1] == b"d") for r in raw])
    out = []
    for kind in np.unique(kinds):
        at = np.flatnonzero(kinds == kind)
        body = b"".join(raw[i][1:] for i in at)
        out.append((at, np.frombuffer(body, "<f8" if kind % 2 else "<f4").reshape(len(at), -1).astype(float)))
    return out


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, digest (null for vectors that link with nothing), length, vector (see ``packed``)."""

    def read(batches):
        for batch in batches:
            digests, lengths, raw = [], [], []
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.array(v.values.to_numpy(zero_copy_only=False), float) + 0.0 if v.is_valid else np.zeros(0)
                fine = vec_id is not None and len(x) and np.isfinite(x).all() and x.any()
                raw.append(packed(x) if fine else None)
                lengths.append(len(x))
                digests.append(blake2b(raw[-1], digest_size=16).digest() if fine else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(lengths, pa.int32()), pa.array(raw, pa.binary())],
                names=["vec_id", "digest", "length", "vector"],
            )

    chosen = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return chosen.mapInArrow(read, "vec_id long, digest binary, length int, vector binary")


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def near_vectors(
    vectors: DataFrame, *, least: float = 0.95, functions: int | None = None, tables: int | None = None, chunk: int = 1024
) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors`` (vec_id, embedding).

    ``functions`` is the number of hashes of a bucket (default ``functions_for`` the
    distinct vectors), ``tables`` at most 64 (default ``TABLES``).
    """
    rows = materialize(distinct_vectors(vectors), "vectors")
    members = rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("vec_id").alias("node"),
        F.count(F.lit(1)).alias("copies"),
        F.first("length").alias("length"),
        F.first("vector").alias("vector"),
    )
    members = materialize(members, "distinct-vectors")
    if functions is None:
        total = members.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("length")).first()
        functions = functions_for(total.n, total.length or 1)
    tables = tables or TABLES[functions]
    probes = functions + 1

    def post(batches):
        for batch in batches:
            for at, x in unpacked(batch.column("vector").to_pylist()):
                for part in np.array_split(np.arange(len(at)), -(-len(at) // 2000)):
                    keys = bucket_keys(_unit(x[part]), functions, tables).reshape(-1).view(np.int32)
                    some = batch.take(pa.array(at[part]))
                    lists = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * (tables * probes), keys)
                    yield pa.RecordBatch.from_arrays([*some.columns, lists], names=[*some.schema.names, "keys"])

    held = members.select("node", "copies", "length", "vector")
    hashed = held.mapInArrow(post, "node long, copies long, length int, vector binary, keys array<int>")
    hashed = materialize(hashed, "hashed-vectors")

    def bucket(key, pos):
        table = F.col("length").cast("long") * 64 + F.floor(pos / probes)
        return F.shiftleft(table, 32) + key.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))

    postings = hashed.select("node", F.explode(F.array_distinct(F.transform("keys", bucket))).alias("bucket"))

    def verify(batches):
        columns = ["node", "copies", "vector", "keys", "bucket", "side"]
        for starts, crossed, (node, copies, raw, keys, bucket, side) in buckets.runs(batches, columns):
            n = len(node)
            node, copies, bucket = node.to_numpy(), copies.to_numpy(), bucket.to_numpy()
            side = side.to_numpy(zero_copy_only=False)
            groups = unpacked(raw.to_pylist())
            unit = np.zeros((n, max(x.shape[1] for _, x in groups)))
            for at, x in groups:
                unit[at, : x.shape[1]] = _unit(x)
            keys = keys.flatten().to_numpy().view(np.uint32).astype(np.int64).reshape(n, tables, probes)
            low = bucket & 0xFFFFFFFF
            table = (bucket >> 32) & 63

            def linked(a, b):
                hit = np.einsum("ij,ij->i", unit[a], unit[b]) >= least
                at = np.flatnonzero(hit)
                for some in np.array_split(at, -(-len(at) // 20_000)) if len(at) else ():
                    x, y = keys[a[some]], keys[b[some]]
                    none = np.int64(1) << 40
                    common = np.where((x[:, :, :, None] == y[:, :, None, :]).any(axis=3), x, none).min(axis=2)
                    first = (common < none).argmax(axis=1)
                    lowest = common[np.arange(len(some)), first]
                    hit[some] = (first == table[a[some]]) & (lowest == low[a[some]])
                return hit

            def open_pairs(a, b):  # near enough but for rounding, and not met by their first axes in an earlier table
                out = unit[a] @ unit[b].T >= least - 1e-9
                for t in range(table[a[0]]):
                    out &= keys[a, t, 0][:, None] != keys[b, t, 0][None, :]
                return out

            forest, links = buckets.Forest(n), np.zeros(n, np.int64)
            for a, b in buckets.pairs(starts, crossed, side, n, linked, open_pairs):
                forest.join(a, b)
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
            a, b = forest.links()
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([node[a], node[some]])), pa.array(np.concatenate([node[b], node[some]])),
                 pa.array(np.concatenate([np.zeros(len(a), np.int64), links[some]]))],
                names=["a", "b", "links"],
            )

    met = buckets.cells(postings, "node", payload=hashed.drop("length"), chunk=chunk)
    found = met.mapInArrow(verify, "a long, b long, links long")
    found = materialize(found, "vector-links")
    several = rows.where("digest IS NOT NULL").groupBy("vec_id").agg(F.min("digest").alias("least"), F.max("digest").alias("most"))
    several = materialize(several.where("least <> most").select("vec_id"), "repeated-vectors")
    own = rows.select("vec_id", "digest").join(several.hint("merge"), "vec_id").distinct()
    own = own.join(members.select("digest", "node"), "digest").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    component = connected_components(found.where("a != b").select("a", "b").unionByName(own), "a", "b")
    counted = materialize(found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links")), "link-counts")
    named = members.select("digest", "node", "copies").join(counted, "node", "left").join(component, "node", "left")
    named = named.select(
        "digest",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    named = materialize(named, "named-vectors")
    all_rows = rows.select("vec_id", "digest").join(named, "digest", "left")
    own = F.coalesce("component_id", "vec_id").alias("component_id")
    return all_rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own, F.col("vec_id").eqNullSafe(own).alias("kept")
    )
