"""WARC archives in Zstandard: a writer, and a reader that checks what it reads.

An archive begins with a skippable frame that holds the dictionary; every record is one frame. The
reader loads the dictionary, decodes frame by frame from any (path, content) rows, such as those of
Spark's ``binaryFile`` source, and checks each record's version, headers, lengths and payload digest.

Equal payloads are stored once: the record with the largest id is the response, the others are revisits
without a payload, which name it and keep digest and length. Only ids and digests are grouped, and rows
meet their page again by id, so no group of equal payloads is gathered.

Null html is an empty payload. A null url gives no target header. Rows that agree in id and payload are
responses alike if their id is the largest. An empty table gives no archive and no rows. A broken record
comes out with its ``problem``; what follows a broken frame in an archive can't be read and is one row.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import cut, hashed_share, pick

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
RECORD = "urn:gridpulse:page:"
FIELDS = {
    "page_id": ("bigint", pa.int64()),
    "url": ("string", pa.string()),
    "record_type": ("string", pa.string()),
    "refers_to": ("bigint", pa.int64()),
    "payload_bytes": ("bigint", pa.int64()),
    "payload_digest": ("string", pa.string()),
    "payload": ("binary", pa.binary()),
    "archive": ("string", pa.string()),
    "problem": ("string", pa.string()),
}


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit (``refers_to``) keeps the HTTP headers and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{RECORD}{'' if page_id is None else page_id}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}")
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <{RECORD}{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def _page_number(text: str) -> int | None:
    number = text.strip("<>").removeprefix(RECORD)
    return int(number) if number else None


def parse(raw: bytes) -> dict:
    """The fields of one record; raises ValueError where it breaks the format."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header without a colon: {line[:40]}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in fields:
            raise ValueError(f"no {name}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"content-length {length}, but {len(rest) - 4} bytes")
    http, mark, payload = rest[:length].partition(b"\r\n\r\n")
    sizes = [x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not mark or len(sizes) != 1:
        raise ValueError("no HTTP content-length")
    size, digest = int(sizes[0].split(b":")[1]), fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if revisit and (payload or "warc-refers-to" not in fields):
        raise ValueError("a revisit with a payload or without its response")
    if not revisit and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError("payload differs from its length or digest")
    return {
        "page_id": _page_number(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "refers_to": _page_number(fields["warc-refers-to"]) if revisit else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload,
    }


def read_archive(content: bytes, step: int = 4096) -> Iterator[dict]:
    """The records of one archive, in order; a record that can't be read has a ``problem`` only."""
    view, at, dictionary = memoryview(content), 0, None
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", content, 4)[0]
        stored = content[8 : 8 + size]
        if stored[:4] == FRAME_MAGIC:
            stored = zstandard.ZstdDecompressor().decompressobj().decompress(stored)
        dictionary, at = zstandard.ZstdCompressionDict(stored), 8 + size
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(view):
        frame, parts = decoder.decompressobj(), []
        try:
            while not frame.eof:
                if at >= len(view):
                    raise ValueError("the archive ends inside a frame")
                chunk = view[at : at + step]
                parts.append(frame.decompress(chunk))
                at += len(chunk) - len(frame.unused_data)
        except (zstandard.ZstdError, ValueError) as error:
            yield {"problem": f"frame: {error}"}
            return
        try:
            yield parse(b"".join(parts))
        except (ValueError, UnicodeDecodeError) as error:
            yield {"problem": f"record: {error}"}


def train_dictionary(pages: DataFrame, samples: int = 400, size: int = 16_384) -> bytes:
    """A dictionary from about ``samples`` pages of at most 16 KB, chosen by a hash; empty if too few."""
    short = pages.where(F.octet_length("html") <= 16_384)
    chosen = short.where(hashed_share(F.col("page_id"), samples, short.count(), "warc")).limit(4 * samples)
    texts = [r["html"].encode() for r in chosen.select("html").collect() if r["html"]]
    if len(texts) < 20:
        return b""
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def with_record_types(pages: DataFrame) -> DataFrame:
    """Adds ``refers_to``: the largest id of the same payload, null for that one."""
    pages = pages.withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    ids = pages.select("page_id", "digest")
    largest = ids.groupBy("digest").agg(F.max("page_id").alias("largest"))
    known = ids.dropDuplicates().join(largest, "digest").where("NOT page_id <=> largest AND largest IS NOT NULL")
    known = known.select(F.col("page_id").alias("known_id"), F.col("digest").alias("known_digest"), F.col("largest").alias("refers_to"))
    same = (pages["digest"] == known["known_digest"]) & pages["page_id"].eqNullSafe(known["known_id"])
    return pages.join(known, same, "left").select("page_id", "url", "html", "refers_to")


def write_archives(pages: DataFrame, dictionary: bytes, archive_bytes: int = 4 << 20, level: int = 3) -> DataFrame:
    """(path, content) rows, each one archive of about ``archive_bytes``; a task writes its own."""

    def run(batches):
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        coder = zstandard.ZstdCompressor(level=level, dict_data=known) if known else zstandard.ZstdCompressor(level=level)
        first = dictionary_frame(dictionary) if dictionary else b""
        held, size, number = [first], 0, 0

        def row():
            content = b"".join(held)
            name = f"{hashlib.sha1(content).hexdigest()}-{number:05d}.warc.zst"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], names=["path", "content"])

        for batch in batches:
            for page in batch.to_pylist():
                payload = (page["html"] or "").encode()
                held.append(coder.compress(record(page["page_id"], page["url"], payload, page["refers_to"])))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield row()
                    held, size, number = [first], 0, number + 1
        if size:
            yield row()

    return pages.mapInArrow(run, "path string, content binary")


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """A row for each record of (path, content) rows."""
    names = [f for f in FIELDS if with_payload or f != "payload"]

    def rows_of(found: list[dict]):
        columns = [pa.array([r.get(n) for r in found], FIELDS[n][1]) for n in names]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                found = []
                for item in read_archive(content.as_py()):
                    found.append(item | {"archive": path.as_py()})
                    if len(found) == 500:
                        yield rows_of(found)
                        found = []
                if found:
                    yield rows_of(found)

    schema = ", ".join(f"{n} {FIELDS[n][0]}" for n in names)
    return archives.select("path", "content").mapInArrow(run, schema)


def round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write every row into archives, stored in the shared folder, and read the records back."""
    pages = pick(df, page_id=id_col, url=url_col, html=html_col)
    pages = pages.withColumn("page_id", F.col("page_id").cast("bigint"))
    archives = cut(write_archives(with_record_types(pages), train_dictionary(pages)))
    return read_archives(archives, with_payload=False)
