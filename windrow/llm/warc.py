"""WARC archives whose records are compressed one by one with a common dictionary.

A Zstandard dictionary is built from archived pages and stands, in a skippable frame, in front
of every archive; each record is a frame of its own, so any record can be read alone.
Pages with the same payload are written once, the others are revisits of that record.
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

from windrow.llm import common, files
from windrow.session import materialise

#: Payloads from this size on may be revisits; the frame that holds a dictionary.
LEAST_REVISIT = 1000
DICTIONARY_FRAME, FILLER_FRAME = 0x184D2A5D, 0x184D2A50

#: The dictionary is built from this many pages (of the lowest hashes of their ids), each with
#: at most so many bytes, and has at most so many bytes itself. Only the size of files, not
#: their content, depends on it.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 16 << 10, 64 << 10

#: Bytes of records, as they are before compression, at which an archive is closed.
ARCHIVE_BYTES = 32 << 20

#: The date of every record; a parameter of the writer, so that a rerun writes the same bytes.
DATE = "2020-01-01T00:00:00Z"

CRLF = b"\r\n"


def build_dictionary(pages: DataFrame, page_id: str, html: str) -> bytes:
    """From a bounded sample; empty when there is nothing to learn from."""
    hashed = pages.select(F.xxhash64(page_id).alias("h"), F.encode(F.substring(html, 1, SAMPLE_BYTES), "utf-8").alias("b"))
    hashed = hashed.where(F.length("b") > 0)
    # First the hashes alone, so that tasks send numbers, not pages.
    lowest = hashed.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES).agg(F.max("h")).scalar()
    chosen = hashed.where(F.col("h") <= lowest).groupBy("h").agg(F.min("b").alias("b")).orderBy("h")
    sample = [bytes(r.b)[:SAMPLE_BYTES] for r in chosen.collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except (zstandard.ZstdError, ValueError):
        # Too few or too small samples to train on: their bytes as they are serve too.
        return b"".join(sample)[:DICTIONARY_BYTES]


def _record(kind: str, name: str, url: str, digest: bytes, payload: bytes | None, size: int, refers: str | None) -> bytes:
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % size, b"", b""]
    block = CRLF.join(http) + (payload or b"")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{name}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": "".join(url.split()),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(digest).decode(),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if kind == "revisit":
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = f"<{refers}>"
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in head.items()), "", ""]
    return "\r\n".join(lines).encode() + block + CRLF + CRLF


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def _name(page_id) -> str:
    return "urn:page:" + ("" if page_id is None else str(page_id))


def _writer(dictionary: bytes, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count, held = TaskContext.get().partitionId(), 0, 0
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=6, dict_data=known)
        begin = [_skippable(DICTIONARY_FRAME, dictionary)]
        out = list(begin)

        def close() -> pa.RecordBatch:
            nonlocal out, held, count
            # The filler ends the file in the byte that the writer asks for.
            content = b"".join([*out, _skippable(FILLER_FRAME, b"\0" * 4)])
            out, held, count = list(begin), 0, count + 1
            name = f"{part:08d}-{count - 1:08d}"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], names=["name", "content"])

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, html, refers = (batch.column(c)[i].as_py() for c in range(4))
                payload = (html or "").encode()
                kind = "response" if refers is None else "revisit"
                digest = hashlib.sha1(payload).digest()
                body = payload if refers is None else None
                record = _record(kind, _name(page_id), url or "", digest, body, len(payload), None if refers is None else _name(refers))
                out.append(packer.compress(record))
                held += len(record)
                if held >= archive_bytes:
                    yield close()
        if len(out) > 1:
            yield close()

    return run


def revisits(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that another page's record stands for.

    Of equal payloads of at least ``LEAST_REVISIT`` bytes the largest id is the response. Only
    digests are grouped, after a partial aggregate, so a payload that a third of all pages
    share is one row per task. Rows with the largest id are all responses; a null id counts
    as the smallest, and without any id all rows are responses.
    """
    text = F.coalesce(F.col(html), F.lit(""))
    # Equal digests of 256 bits stand for equal payloads.
    seen = pages.select(F.col(page_id).alias("page_id"), F.sha2(text, 256).alias("digest"), F.octet_length(text).alias("n"))
    seen = materialise(seen.where(F.col("n") >= LEAST_REVISIT).select("page_id", "digest"), "digests")
    groups = seen.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    groups = groups.where((F.col("n") > 1) & F.col("refers_to").isNotNull()).select("digest", "refers_to")
    return (
        seen.join(groups, "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "digest", "refers_to")
        .distinct()
    )


def write(pages: DataFrame, path: str, page_id: str, url: str, html: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """One record per row, in archives below ``path``. A null html is an empty payload, a null url is empty.

    Pages stay where they were read, as the list of revisits is joined to them: by broadcast
    when it is counted to be small, else by a shuffle on the id and the digest.
    """
    dictionary = build_dictionary(pages, page_id, html)
    text = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), F.sha2(text, 256).alias("digest")
    )
    again = materialise(revisits(pages, page_id, html), "revisits").withColumnsRenamed({"page_id": "_id", "digest": "_digest"})
    again = common.broadcast_if_bounded(again, 160)
    on = rows["page_id"].eqNullSafe(again["_id"]) & (rows["digest"] == again["_digest"])
    made = rows.join(again, on, "left").select("page_id", "url", "html", "refers_to")
    files.write(made.mapInArrow(_writer(dictionary, archive_bytes), "name string, content binary"), path, "name", "content")


def frames(content: bytes) -> Iterator[tuple[int | None, bytes]]:
    """(magic, content) of skippable frames and (None, frame) of the others, in order."""
    at, view = 0, memoryview(content)
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == FILLER_FRAME & 0xFFFFFFF0:
            yield magic, bytes(view[at + 8 : at + 8 + size])
            at += 8 + size
        else:
            length = _frame_length(view, at)
            yield None, bytes(view[at : at + length])
            at += length


def _frame_length(view: memoryview, at: int) -> int:
    """Walks the blocks of the frame that begins at ``at``, as its format lays them out."""
    head = zstandard.frame_header_size(view[at : at + 18])
    checksum = zstandard.get_frame_parameters(view[at : at + 18]).has_checksum
    end = at + head
    while True:
        block = int.from_bytes(view[end : end + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        end += 3 + (1 if kind == 1 else size)
        if last:
            return end + 4 * checksum - at


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive."""
    opener = zstandard.ZstdDecompressor()
    for magic, body in frames(content):
        if magic == DICTIONARY_FRAME and body:
            opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
        elif magic is None:
            head, _, rest = opener.decompress(body).partition(CRLF + CRLF)
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            yield fields, rest[: int(fields["Content-Length"])]


def _page_id(name: str) -> str | None:
    return name.removeprefix("<urn:page:").removesuffix(">") or None


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [(c, pa.string()) for c in ("page_id", "url", "payload_digest", "record_type", "refers_to")]
        + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
    )
    for batch in batches:
        for content in batch.column(1):
            rows = []
            for fields, block in records(content.as_buffer().to_pybytes()):
                http, _, payload = block.partition(CRLF + CRLF)
                size = next(int(x[16:]) for x in http.split(CRLF) if x.startswith(b"Content-Length: "))
                digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                kind = fields["WARC-Type"]
                if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                rows.append(
                    {
                        "page_id": _page_id(fields["WARC-Record-ID"]),
                        "url": fields["WARC-Target-URI"],
                        "payload_digest": digest,
                        "record_type": kind,
                        "refers_to": _page_id(fields["WARC-Refers-To"]) if kind == "revisit" else None,
                        "payload_bytes": size,
                        "payload": payload if kind == "response" else None,
                    }
                )
                if len(rows) >= 128:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema)


def read(spark, path: str, kind: str = "bigint") -> DataFrame:
    """One row per record; a response's payload is checked against its digest."""
    schema = (
        "page_id string, url string, payload_digest string, record_type string, refers_to string, "
        "payload_bytes bigint, payload binary"
    )
    found = files.read(spark, path).mapInArrow(_reader, schema)
    return found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
