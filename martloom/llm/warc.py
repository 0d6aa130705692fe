"""WARC archives with a Zstandard dictionary.

Each task writes one ``.warc.zst`` style file: a leading skippable frame holds
a dictionary built from the file's own records, then every record is a
Zstandard frame of its own, compressed with that dictionary. Files are written
and read by Spark, so they may lie in any store Spark reaches.

Spark's text sink ends every row with a newline; a file is therefore one row
that ends in a skippable frame, which readers of the format skip, whose content
is the number of records and that newline. A file cut anywhere is thus known
to be incomplete.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import checkpoint_dir

# Fixed values of the formats.
ZSTD_MAGIC = 0xFD2FB528
DICTIONARY_FRAME = 0x184D2A5D
FILLER_FRAME = 0x184D2A50
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

DICTIONARY_BYTES = 64 * 1024
SAMPLE_BYTES = 4 * 1024 * 1024   # bytes a file's dictionary is built from, about
SAMPLE_PIECE = 4 * 1024          # drawn evenly from all records, over their whole length, in pieces of so many bytes
FILE_BYTES = 16 * 1024 * 1024    # payload in a file, about
LEVEL = 3
FREQUENT = 1000                  # a payload of more than one page in so many is not joined by content
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str | None) -> str:
    return " ".join((value or "").split())


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit names its response and carries no payload."""
    head = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
            f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    body = b"" if revisit else payload
    head += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def dictionary_of(records: list[bytes]) -> bytes:
    """A dictionary from evenly spaced pieces of all records, about ``SAMPLE_BYTES`` of them.

    It decides how well the file compresses and nothing else. Too few or too
    uniform pieces cannot be trained on; the dictionary is then the raw content
    of the pieces themselves (possibly empty).
    """
    pieces = [r[at : at + SAMPLE_PIECE] for r in records for at in range(0, len(r), SAMPLE_PIECE)]
    sample = pieces[:: max(1, -(-sum(map(len, pieces)) // SAMPLE_BYTES))]
    size = sum(map(len, sample))
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, size // 8)), sample).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[:DICTIONARY_BYTES]


def write_archive(records: list[bytes]) -> bytes:
    dictionary = dictionary_of(records)
    params = {"level": LEVEL, "write_checksum": True}
    with_dict = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if len(dictionary) >= 8 else {}
    packer = zstandard.ZstdCompressor(**params, **with_dict)
    frames = [skippable(DICTIONARY_FRAME, dictionary), *(packer.compress(r) for r in records)]
    # the sink's newline is the last content byte of the closing frame
    return b"".join(frames) + struct.pack("<IIQ", FILLER_FRAME, 9, len(records))


def _frame(unpacker: zstandard.ZstdDecompressor, view: memoryview, at: int) -> tuple[bytes, int]:
    """The content of the frame at ``at`` and where the next begins."""
    frame, pieces, step = unpacker.decompressobj(), [], 64 * 1024
    try:
        while not frame.eof and at < len(view):
            pieces.append(frame.decompress(view[at : at + step]))
            at += step
    except zstandard.ZstdError as fault:
        raise ValueError(f"damaged frame: {fault}") from fault
    if not frame.eof:
        raise ValueError("truncated frame")
    return b"".join(pieces), min(at, len(view)) - len(frame.unused_data)


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame after the other.

    A ``ValueError`` says that the archive is damaged or incomplete: it must
    begin with its dictionary and end with the closing frame, whose count must
    be the number of records read. An incomplete archive fails at its end.
    """
    at, count, view = 0, 0, memoryview(data)
    unpacker = zstandard.ZstdDecompressor()
    while True:
        if at + 8 > len(data):
            raise ValueError("the archive has no closing frame")
        magic, size = struct.unpack_from("<II", data, at)
        skipped = data[at + 8 : at + 8 + size] if magic & 0xFFFFFFF0 == FILLER_FRAME else b""
        if at == 0:
            if magic != DICTIONARY_FRAME or len(skipped) != size:
                raise ValueError("the archive does not begin with its dictionary")
            if size >= 8:
                try:
                    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(skipped))
                except zstandard.ZstdError as fault:
                    raise ValueError(f"damaged dictionary: {fault}") from fault
            at += 8 + size
        elif magic == FILLER_FRAME:
            if len(skipped) != 9 or skipped != struct.pack("<Q", count) + b"\n" or at + 17 != len(data):
                raise ValueError(f"the closing frame does not close an archive of {count} records")
            return
        elif magic == ZSTD_MAGIC:
            content, at = _frame(unpacker, view, at)
            count += 1
            yield content
        else:
            raise ValueError(f"no frame at byte {at}")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:20]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    length = int(fields["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("record length does not match")
    return fields, rest[:length]


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to, revisit``: among equal payloads of at
    least ``least_bytes`` bytes the largest page id is the response.

    The choice is one aggregation by (length, SHA-256) combined before the
    shuffle. Pages with a payload that more than one page in ``FREQUENT`` has
    get the choice from a broadcast (fewer than ``FREQUENT`` payloads can be so
    frequent) and are spread over the join that serves the others.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("size", F.length("payload").cast("bigint")).withColumn("content", F.sha2("payload", 256))
    first = rows.filter(F.col("size") >= least_bytes).groupBy("size", "content").agg(
        F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
    often = F.col("n") > F.lit(pages.count() / FREQUENT)
    hot = F.broadcast(first.filter(often).select("size", "content", F.col("response_id").alias("hot_id"), F.lit(True).alias("hot")))
    others = first.filter(~often).select("size", "content", "response_id", F.lit(0).cast("bigint").alias("place"))
    place = F.when(F.col("hot"), F.xxhash64("page_id", "url")).otherwise(F.lit(0).cast("bigint"))
    rows = rows.join(hot, ["size", "content"], "left").withColumn("place", place).join(others, ["size", "content", "place"], "left")
    rows = rows.withColumn("response_id", F.when(F.col("hot"), F.col("hot_id")).otherwise(F.col("response_id")))
    revisit = F.coalesce(F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id")), F.lit(False))
    return rows.select("page_id", "url", "payload", revisit.alias("revisit"),
                       F.when(revisit, F.col("response_id")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write the archives of ``pages`` (``page_id, url, html``) under ``path``.

    NULL html is an empty payload, NULL urls are empty. Rows that repeat a
    page id and payload are all responses when that id is the group's
    largest. Very long payloads are written and digested whole. A NULL page id revisits the group's largest id, or is a response
    where no id is known. An empty table writes no record.
    """
    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[bytes] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                waiting.append(record(row["page_id"], row["url"], row["payload"], row["refers_to"], row["revisit"]))
                size += len(waiting[-1])
                if size >= file_bytes:
                    yield pa.record_batch([pa.array([write_archive(waiting)], pa.binary())], names=["archive"])
                    waiting, size = [], 0
        if waiting:
            yield pa.record_batch([pa.array([write_archive(waiting)], pa.binary())], names=["archive"])

    # binary to string keeps the bytes as they are; one row is one file
    built = plan_records(pages, least_bytes).mapInArrow(archives, "archive binary")
    built.select(F.col("archive").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).mode(
        "errorifexists").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row a record: id, payload length and digest, type, the response a revisit names.

    Lengths and digests of responses are recomputed from what was read and
    must equal the headers.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                rows = []
                for fields, body in map(parse_record, read_archive(data.as_py())):
                    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                    kind = fields["WARC-Type"]
                    if kind == "response" and (digest_of(body) != digest or len(body) != size):
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                    ids = [fields.get(f, "").removeprefix("<urn:page:").rstrip(">") for f in ("WARC-Record-ID", "WARC-Refers-To")]
                    page, refers = (int(i) if i else None for i in ids)
                    rows.append((page, size, digest, kind, refers))
                if rows:
                    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                          names=[c.split()[0] for c in RECORDS.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, RECORDS)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives beside the session's checkpoints."""
    return f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
