"""WARC archives of Zstandard frames with a shared dictionary.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, followed by one frame per record.  The reader loads the dictionary
from that frame, decodes frame by frame and checks version line, header fields,
block length, payload length and payload digest; damaged archives raise.

Pages of equal payload become one ``response`` (the largest page_id) and
``revisit`` records that refer to it.  Only digests are compared and grouped; the
pages travel once, to meet the reference of their payload.

The dictionary of an archive is trained on at most ``samples`` of its own
records; an archive holds about ``archive_bytes`` of payload.  Archives are rows
(archive binary) of a table, committed by Spark's writer.

Null html: an empty payload.  Null url: no target header.  Null page_id: a record
without reference that never refers to others; of equal payloads it is a revisit
if another row has a page_id.  Rows that repeat the largest page_id with an equal
payload are all responses.  Empty table: no archives.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specflow.session import materialize

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    name = uri.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def make_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record: a whole HTTP response, or its headers alone for a revisit."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _uri(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if revisit:
        fields += [("WARC-Refers-To", _uri(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def make_archive(records: list[bytes], *, samples: int = 200, dictionary_bytes: int = 32_768, level: int = 3) -> bytes:
    import zstandard

    some = [r[:65_536] for r in records[:: max(1, len(records) // samples)]]  # training may look at heads; records are whole
    try:
        trained = zstandard.train_dictionary(dictionary_bytes, some)
    except zstandard.ZstdError:  # too few or too small samples
        trained = zstandard.ZstdCompressionDict(b"".join(some)[:dictionary_bytes], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw = trained.as_bytes()
    writer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_content_size=True)
    return b"".join([struct.pack("<II", DICTIONARY_MAGIC, len(raw)), raw, *map(writer.compress, records)])


def read_archive(archive: bytes):
    """Records of an archive, one frame each."""
    import zstandard

    if len(archive) < 8:
        raise ValueError("archive without dictionary frame")
    magic, size = struct.unpack_from("<II", archive)
    if magic != DICTIONARY_MAGIC or 8 + size > len(archive):
        raise ValueError("archive without dictionary frame")
    raw = archive[8 : 8 + size]
    if raw[:4] == FRAME_MAGIC:  # the dictionary itself may be compressed
        raw = zstandard.ZstdDecompressor().decompress(raw)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    rest = memoryview(archive)[8 + size :]
    while len(rest):
        if bytes(rest[:4]) != FRAME_MAGIC:
            raise ValueError("expected a frame")
        frame = reader.decompressobj()
        record = frame.decompress(rest)
        if not frame.eof:
            raise ValueError("cut frame")
        rest = rest[len(rest) - len(frame.unused_data) :]
        yield record


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block, validated."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line {line!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"missing header {name}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("block length differs from Content-Length")
    return fields, rest[:length]


def page_of(record: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of a record."""
    fields, block = parse_record(record)
    head, gap, payload = block.partition(b"\r\n\r\n")
    sizes = [line for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    if not gap or len(sizes) != 1:
        raise ValueError("not an HTTP response")
    size, digest = int(sizes[0].split(b":")[1]), fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response":
        if len(payload) != size or sha1_base32(payload) != digest:
            raise ValueError("payload differs from its length or digest")
        refers_to = None
    elif kind == "revisit":
        if payload:
            raise ValueError("a revisit holds no payload")
        refers_to = _page(fields["warc-refers-to"])
    else:
        raise ValueError(f"unknown record type {kind}")
    return _page(fields["warc-record-id"]), size, digest, kind, refers_to


def write_archives(pages: DataFrame, path: str, *, archive_bytes: int = 16 << 20, samples: int = 200, least_bytes: int = 0) -> None:
    """Archives of ``pages`` (page_id, url, html) below ``path``; payloads under ``least_bytes`` are never revisits."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    chosen = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    digests = chosen.select("page_id", F.sha2(F.encode("html", "utf-8"), 256).alias("sha"), F.octet_length("html").alias("n"))
    latest = digests.where(F.col("n") >= least_bytes).groupBy("sha").agg(F.max("page_id").alias("latest"), F.count(F.lit(1)).alias("rows"))
    latest = materialize(latest.where("rows > 1 AND latest IS NOT NULL").select("sha", "latest"), "repeated-payloads")
    joined = chosen.withColumn("sha", F.sha2(F.encode("html", "utf-8"), 256)).join(latest.hint("merge"), "sha", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("latest")), F.col("latest"))

    def write(batches):
        records, size = [], 0

        def close():
            nonlocal records, size
            archive = make_archive(records, samples=samples)
            row = pa.RecordBatch.from_arrays([pa.array([len(records)], pa.int64()), pa.array([archive], pa.binary())], names=["records", "archive"])
            records, size = [], 0
            return row

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch.column(k) for k in range(4))):
                body = payload.as_py().encode()
                records.append(make_record(page_id.as_py(), url.as_py(), body, sha1_base32(body), refers_to.as_py()))
                size += len(records[-1])
                if size >= archive_bytes:
                    yield close()
        if records:
            yield close()

    rows = joined.select("page_id", "url", "html", refers.alias("refers_to"))
    rows.mapInArrow(write, "records long, archive binary").write.mode("error").parquet(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``."""

    def read(batches):
        for batch in batches:
            for archive in batch.column(0):
                columns = list(zip(*map(page_of, read_archive(archive.as_py())))) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    return spark.read.schema("records long, archive binary").parquet(path).select("archive").mapInArrow(read, RECORDS)
