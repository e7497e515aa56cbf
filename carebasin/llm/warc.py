"""WARC archives of pages, Zstandard-compressed with a dictionary.

An archive begins with a skippable frame that holds a dictionary; every record
follows as one frame. The writer cuts each task's records into archives of about
``ARCHIVE_BYTES`` and trains each archive's dictionary on a bounded sample of its
own payloads. The reader loads the dictionary from the leading skippable frame,
decodes one frame per record and validates version, headers, content length,
frame checksum and payload digest; what is wrong with a record is put in
``error`` instead of ending the job.

Archives are rows ``path, content``, the shape that ``spark.read.format(
"binaryFile")`` gives, written as a table to the shared folder: executors write
through Spark only. ``read_archives`` reads either.

Of pages with equal payloads, the one with the largest id is a response and the
others are revisits that refer to it. Payloads meet by digest in a counted table
that is written first, so that a hot payload's join is split.

Defined cases: null html is the empty payload; pages that repeat id and payload
of the largest id are all responses; a null id ranks below all others, and is
read back as null; null urls become ``about:blank``; an empty table gives no
archive and no record. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebasin.sources.writers import stage

#: Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Uncompressed payload bytes after which an archive is closed.
ARCHIVE_BYTES = 8 << 20
#: Payloads, and bytes of each, that a dictionary is trained on; its size.
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 16 << 10, 32 << 10
LEVEL = 3
DATE = "2026-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_uri(page_id) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def headers(fields: list[tuple[str, str]]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)


def encode_record(page_id, url, payload: bytes, payload_digest: str, refers_to) -> bytes:
    """One record; a revisit (``refers_to`` is a one-tuple) leaves the payload out."""
    http = b"HTTP/1.1 200 OK\r\n" + headers(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    ) + b"\r\n"
    block = http if refers_to else http + payload
    target = (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{page_uri(page_id)}>"),
        ("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
    ]
    if refers_to:
        fields += [("WARC-Refers-To", f"<{page_uri(refers_to[0])}>"), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + headers(fields) + b"\r\n" + block + b"\r\n\r\n"


def dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary from the first payloads; empty if they are too few or small."""
    samples = [x[:SAMPLE_BYTES] for x in payloads[:SAMPLES] if x]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 10)
    if len(samples) < 8 or size < 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # samples without anything in common
        return b""


def encode_archive(records: list[bytes], trained: bytes) -> bytes:
    own = zstandard.ZstdCompressionDict(trained) if trained else None
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_checksum=True, write_content_size=True)
    return struct.pack("<II", DICTIONARY_MAGIC, len(trained)) + trained + b"".join(map(packer.compress, records))


def frame_length(content: memoryview, at: int) -> int:
    """Bytes of the frame at a place, from its header and block headers."""
    head = bytes(content[at: at + 18])
    if len(head) < 5 or struct.unpack_from("<I", head)[0] != FRAME_MAGIC:
        raise ValueError("no frame")
    place = at + zstandard.frame_header_size(head)
    while True:
        if place + 3 > len(content):
            raise ValueError("frame is cut off")
        block = int.from_bytes(content[place: place + 3], "little")
        # a run-length block (kind 1) stores one byte
        place += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            break
    place += 4 * (head[4] >> 2 & 1)
    if place > len(content):
        raise ValueError("frame is cut off")
    return place - at


def parse_record(record: bytes) -> dict:
    """Fields of a record; raises ValueError where it is not valid."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError("no WARC version or headers")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon:
            raise ValueError("a header has no colon")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"{name} is missing")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("content length differs")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    sizes = [x.split(b":")[1] for x in http.lower().split(b"\r\n") if x.startswith(b"content-length:")]
    if not gap or not sizes:
        raise ValueError("no HTTP headers")
    kind, stated = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != int(sizes[0]):
            raise ValueError("payload length differs")
        if digest(payload) != stated:
            raise ValueError("payload digest differs")
    elif kind != "revisit" or payload or "warc-refers-to" not in fields:
        raise ValueError("neither a response nor a revisit")
    id_of = lambda x: x.strip("<>").removeprefix("urn:page:") or None
    return {
        "record_id": id_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind,
        "payload_bytes": int(sizes[0]), "payload_digest": stated,
        "refers_to": id_of(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None, "error": None,
    }


FIELDS = ("record_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload", "error")


def decode_archive(content: bytes) -> Iterator[dict]:
    """Records of an archive in order; one that cannot be read has an ``error``,
    and reading ends where no next frame can be found."""
    blank = dict.fromkeys(FIELDS)
    view = memoryview(content)
    magic, size = struct.unpack_from("<II", content) if len(content) >= 8 else (0, 0)
    if magic != DICTIONARY_MAGIC or 8 + size > len(content):
        yield blank | {"error": "no dictionary frame"}
        return
    own = zstandard.ZstdCompressionDict(content[8: 8 + size]) if size else None
    unpacker = zstandard.ZstdDecompressor(dict_data=own)
    at = 8 + size
    while at < len(content):
        try:
            length = frame_length(view, at)
        except (ValueError, zstandard.ZstdError) as error:
            yield blank | {"error": str(error)}
            return
        try:
            yield parse_record(unpacker.decompress(view[at: at + length]))
        except (ValueError, zstandard.ZstdError) as error:
            yield blank | {"error": str(error)}
        at += length


def with_digests(pages: DataFrame) -> DataFrame:
    """``page_id, url, html`` with ``digest``; nulls of html become empty."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))


def with_references(pages: DataFrame) -> DataFrame:
    """Add ``refers``: a one-field struct for revisits, null for responses."""
    digests = with_digests(pages)
    first = digests.groupBy("digest").agg(F.max("page_id").alias("response"))
    first = stage(first, "warc-responses")
    joined = digests.join(first.hint("merge"), "digest")
    revisit = ~F.col("page_id").eqNullSafe(F.col("response"))
    return joined.select(
        "page_id", "url", "html", F.when(revisit, F.struct(F.col("response").cast("string").alias("id"))).alias("refers")
    )


def write_archives(pages: DataFrame) -> DataFrame:
    """Write all pages as archives; returns the table ``path, content`` reread."""

    def pack(batches):
        records, payloads, size = [], [], 0

        def close():
            archive = encode_archive(records, dictionary(payloads))
            name = f"pages-{hashlib.sha1(archive).hexdigest()[:20]}.warc.zst"
            return pa.record_batch([pa.array([name]), pa.array([archive], pa.binary())], ["path", "content"])

        for batch in batches:
            for page_id, url, html, refers in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers"))):
                payload = html.as_buffer().to_pybytes()
                reference = refers.as_py()
                reference = reference and (reference["id"],)
                records.append(encode_record(page_id.as_py(), url.as_py(), payload, digest(payload), reference))
                payloads.append(payload)
                size += len(records[-1])  # with its headers, so that many empty pages fill an archive too
                if size >= ARCHIVE_BYTES:
                    yield close()
                    records, payloads, size = [], [], 0
        if records:
            yield close()

    return stage(with_references(pages).mapInArrow(pack, "path string, content binary"), "warc-archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """All records of archives ``path, content``."""
    schema = "path string, record_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary, error string"
    types = [pa.string()] * 3 + [pa.int64()] + [pa.string()] * 2 + [pa.binary(), pa.string()]

    def unpack(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows, size = [], 0

                def cut():
                    columns = [pa.array([r[f] for r in rows], t) for f, t in zip(FIELDS, types)]
                    return pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), *columns], ["path", *FIELDS])

                for row in decode_archive(content.as_buffer().to_pybytes()):
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if size > ARCHIVE_BYTES or len(rows) >= 10_000:
                        yield cut()
                        rows, size = [], 0
                if rows:
                    yield cut()

    return archives.select("path", "content").mapInArrow(unpack, schema)


def report(pages: DataFrame) -> DataFrame:
    kind = dict(pages.dtypes)["page_id"]
    records = read_archives(write_archives(pages))
    return records.select(
        F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "error",
    )
