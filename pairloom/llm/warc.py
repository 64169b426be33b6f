"""WARC archives, one Zstandard frame per record, with the dictionary in front.

An archive begins with a skippable frame that holds a dictionary; every record is a frame
of its own, compressed with it. Archives are written by Spark's text writer: each row is a
frame's bytes, and the line separator is an empty skippable frame, which readers of the
format pass over. So they are committed like any Spark output, on any file system
Spark writes to, and a task that is run again leaves no second copy. Each partition makes
one archive and trains its dictionary on its first records.

Payloads that repeat are stored once: the page with the least id holds the response, the
others are revisit records that name it. Their HTTP headers still tell the payload's
length, and the WARC header its digest. Equal pages with equal ids are all responses, and
so are pages without an id unless a page with one has the same payload.

The reader checks the version, the needed headers, the lengths of block and payload, the
digest, the end of the record and that a frame holds exactly one, and raises with the
archive and offset otherwise. Null payloads are empty; null urls and ids read back as null.
An empty table makes archives without records.
"""

import base64
import re
import struct
from hashlib import sha1
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.staging import staged

from .common import raw_text, ship, slices, small

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
EMPTY_FRAME = "P*M\x18\0\0\0\0"  # 0x184D2A50, length 0
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = {"warc-type", "warc-record-id", "warc-date", "content-length"}

#: A record's time: parameter, so that archives do not depend on when they were written.
DATE = "1970-01-01T00:00:00Z"
#: Payloads of fewer bytes are all stored as responses.
LEAST_REVISIT_BYTES = 0
LEVEL = 3
#: Records, and bytes of them, that a partition's dictionary is trained on; its size.
TRAIN_RECORDS, TRAIN_BYTES, DICTIONARY_BYTES = 256, 2 << 20, 32 << 10
#: Compressed bytes fed to the decoder at a time.
FEED = 32 << 10


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d*)>", record_id)
    if not found:
        raise ValueError(f"record id {record_id!r}")
    return int(found[1]) if found[1] else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The bytes of a response record, or of a revisit record if it refers to another page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    head = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=~.-_' + chr(39))}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> bytes | None:
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except zstd.ZstdError:  # too few or too small records
        return None


def _frames(batches):
    """Rows of one archive: the dictionary's frame, then a frame for each record."""
    compress = None
    waiting: list[bytes] = []
    size = 0

    def start():
        made = _dictionary(waiting)
        if made is None:
            return zstd.ZstdCompressor(level=LEVEL).compress, []
        data = zstd.ZstdCompressionDict(made)
        data.precompute_compress(level=LEVEL)
        lead = struct.pack("<II", DICTIONARY_MAGIC, len(made)) + made
        return zstd.ZstdCompressor(level=LEVEL, dict_data=data).compress, [lead]

    def rows(frames: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

    for batch in slices(batches):
        names = ("page_id", "url", "payload", "digest", "refers_to")
        for page_id, url, payload, digest, refers_to in zip(*(batch.column(n).to_pylist() for n in names)):
            waiting.append(record(page_id, url, payload, base32(digest), refers_to))
            size += len(waiting[-1])
            if compress is None and len(waiting) < TRAIN_RECORDS and size < TRAIN_BYTES:
                continue
            lead = []
            if compress is None:
                compress, lead = start()
            if lead or size >= TRAIN_BYTES:
                yield rows([*lead, *map(compress, waiting)])
                waiting, size = [], 0
    if compress is None and waiting:
        compress, lead = start()
        yield rows([*lead, *map(compress, waiting)])
    elif waiting:
        yield rows(list(map(compress, waiting)))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_revisit_bytes: int = LEAST_REVISIT_BYTES,
) -> None:
    """Write ``pages`` as archives in the folder ``path``, an archive for each partition."""
    ship(pages.sparkSession)
    source = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), raw_text(payload_col).alias("payload")
    )
    digests = source.select("page_id", F.sha1("payload").alias("digest"), F.length("payload").alias("size"))
    first = staged(
        digests.filter(F.col("size") >= least_revisit_bytes)
        .groupBy("digest", "size")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("pages"))
        .filter("pages > 1")
        .select("digest", "size", "first_id"),
        "responses",
    )
    keyed = source.withColumn("digest", F.sha1("payload")).withColumn("size", F.length("payload"))
    other = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = keyed.join(small(first, 96), ["digest", "size"], "left").select(
        "page_id", "url", "payload", "digest", F.when(other, F.col("first_id")).alias("refers_to")
    )
    frames = rows.mapInArrow(_frames, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).text(path)


def frames_of(content: bytes):
    """(offset, decoded bytes) of each frame of an archive."""
    view, at, decoder = memoryview(content), 0, zstd.ZstdDecompressor()
    while at < len(view):
        if len(view) - at < 4:
            raise ValueError(f"{at}: the archive ends within a frame")
        (magic,) = struct.unpack_from("<I", view, at)
        if magic in SKIPPABLE:
            if len(view) - at < 8:
                raise ValueError(f"{at}: the archive ends within a frame")
            (size,) = struct.unpack_from("<I", view, at + 4)
            if at + 8 + size > len(view):
                raise ValueError(f"{at}: the archive ends within a frame")
            if magic == DICTIONARY_MAGIC and at == 0:
                held = bytes(view[8 : 8 + size])
                if held[:4] == zstd.FRAME_HEADER:  # a dictionary may itself be compressed
                    held = zstd.ZstdDecompressor().decompress(held)
                decoder = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(held))
            at += 8 + size
            continue
        start, one, parts = at, decoder.decompressobj(), []
        try:
            while not one.eof:
                fed = view[at : at + FEED]
                if not fed:
                    raise ValueError(f"{start}: the archive ends within a frame")
                parts.append(one.decompress(fed))
                at += len(fed)
        except zstd.ZstdError as e:
            raise ValueError(f"{start}: {e}") from e
        at -= len(one.unused_data)
        yield start, b"".join(parts)


def parse(data: bytes) -> dict:
    """The record that a frame holds; ValueError if it is not one whole valid record."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] != VERSION.decode():
        raise ValueError("no WARC/1.1 header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header line {line!r}")
        fields[name.strip().lower()] = value.strip()
    if missing := NEEDED - fields.keys():
        raise ValueError(f"no {min(missing)}")
    length = int(fields["content-length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise ValueError("block length")
    http, found, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^content-length: *(\d+)\r?$", http)
    if not found or not size:
        raise ValueError("no HTTP header with a length")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    refers_to = None
    if kind == "response":
        if len(payload) != int(size[1]) or base32(sha1(payload).hexdigest()) != digest:
            raise ValueError("payload length or digest")
    elif kind == "revisit":
        if payload or "warc-refers-to" not in fields or fields.get("warc-profile") != REVISIT:
            raise ValueError("revisit record")
        refers_to = _page_id(fields["warc-refers-to"])
    else:
        raise ValueError(f"record type {kind!r}")
    url = fields.get("warc-target-uri")
    return {
        "page_id": _page_id(fields["warc-record-id"]),
        "url": None if url is None else unquote(url),
        "record_type": kind,
        "payload_bytes": int(size[1]),
        "payload_digest": digest,
        "refers_to": refers_to,
        "payload": payload if kind == "response" else None,
    }


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
_RECORD_DDL = (
    "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string,"
    " refers_to bigint"
)
#: Decoded bytes of a result batch.
BATCH_BYTES = 8 << 20


def _decode(payloads: bool):
    schema = _RECORD if payloads else pa.schema(list(_RECORD)[:-1])

    def decode(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows, size = [], 0
                try:
                    for at, data in frames_of(content.as_py()):
                        try:
                            rows.append(parse(data))
                        except ValueError as e:
                            raise ValueError(f"{at}: {e}") from e
                        size += len(data)
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                except ValueError as e:
                    raise ValueError(f"{path}: offset {e}") from e
                yield pa.RecordBatch.from_pylist(rows, schema)

    return decode


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for each record: page_id, url, record_type, payload_bytes, payload_digest, refers_to (, payload)."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(_decode(payloads), _RECORD_DDL + ", payload binary" * payloads)
