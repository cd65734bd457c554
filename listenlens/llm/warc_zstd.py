"""WARC archives compressed with Zstandard: a writer and a validating reader.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, followed by one Zstandard frame for each record.  The reader loads
the dictionary from that frame, decodes one record per frame and checks the
version line, the mandatory headers, the block's length and digest, the payload's
length and its digest.  It reads archives of other writers too: every record type,
any record id, header names in either case, folded header lines, digests in
hexadecimal or base32, chunked bodies, records without a payload digest.

A record that fails becomes a row with nothing but ``error``; frames cannot be found
again behind a broken one, so that row stands for the rest of its archive.  With
``strict`` the first such record raises ``ValueError``.

Archives are rows ``(name, content)`` of about ``archive_bytes``, so any store
that Spark reaches can hold them as a Parquet table; ``read_files`` loads
``.warc.zst`` files the same way.

Of records with equal payloads of ``revisit_bytes`` or more, that with the
largest id is a ``response`` and the others are ``revisit`` records that refer
to it; they keep the HTTP head (with the payload's length) and the digest.

Defined results
---------------
* null payload: empty, a response; null url: an empty target;
* null id: written as such, apart from any string id; it is a response only when no other row of the
  group has an id;
* repeated rows and equal ids: one record per row; rows that share the largest
  id of a group are all responses;
* empty table: no archive, no record; other columns are ignored;
* too few payloads for a dictionary: archives without the skippable frame.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.llm.common import map_batches, text_or_empty, written

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_BYTES = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
URN, NO_ID = "<urn:page:%s>", "<urn:page>"
RECORDS = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("target", T.StringType()), T.StructField("payload", T.BinaryType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("refers_to", T.StringType()),
    T.StructField("error", T.StringType())])
#: Payload bytes of a batch of records, about.
READ_BYTES = 8 << 20


def record(page_id, url: str | None, payload: bytes, digest: str, n_bytes: int, refers_to=None) -> bytes:
    """One WARC/1.1 record; ``refers_to`` makes it a revisit without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _urn(page_id)),
            ("WARC-Date", "2000-01-01T00:00:00Z"),  # the pages carry no time
            ("WARC-Target-URI", quote(url or "", safe=";/?:@&=+$,!~*'()#%[]")),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    head.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple:
    """A decoded frame as a row of ``RECORDS``; raises ``ValueError`` if invalid."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    first, _, lines = head.partition(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", first):
        raise ValueError("no WARC version line")
    fields = _fields(lines)
    if missing := [k for k in MANDATORY if k.lower() not in fields]:
        raise ValueError(f"headers missing: {missing}")
    n = _length(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {n}, but the block has {len(rest) - 4} bytes")
    block, kind = rest[:n], fields["warc-type"].lower()
    if not _agrees(fields.get("warc-block-digest"), block):
        raise ValueError("block does not match its digest")
    refers, stated = fields.get("warc-refers-to"), fields.get("warc-payload-digest")
    http, payload = {}, block
    if fields.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
        top, _, payload = block.partition(b"\r\n\r\n")
        http = _fields(top.partition(b"\r\n")[2])
    ident = (_page(fields["warc-record-id"]), kind, fields.get("warc-target-uri"))
    if kind == "revisit":
        if payload:
            raise ValueError("revisit with a payload")
        length = _length(http["content-length"]) if "content-length" in http else None
        return (*ident, None, length, _digest(stated)[1].hex() if stated else None, _page(refers) if refers else None, None)
    whole = "warc-truncated" not in fields and "warc-segment-number" not in fields
    if "chunked" in http.get("transfer-encoding", "").lower():
        body = _unchunked(payload) if whole else payload
        if not (_agrees(stated, body) or _agrees(stated, payload)):
            raise ValueError("payload does not match its digest")
        payload = body
    else:
        if whole and kind == "response" and "content-length" in http and _length(http["content-length"]) != len(payload):
            raise ValueError("payload does not match its length")
        if whole and not _agrees(stated, payload):
            raise ValueError("payload does not match its digest")
    return (*ident, payload, len(payload), hashlib.sha1(payload).hexdigest(), _page(refers) if refers else None, None)


def _fields(lines: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a line that starts with a blank continues the one before."""
    text = re.sub(r"\r\n[\x20\t]+", " ", lines.decode("utf-8", "replace"))
    pairs = (line.partition(":") for line in text.split("\r\n"))
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _length(text: str) -> int:
    if not re.fullmatch("[0-9]{1,18}", text):
        raise ValueError(f"length {text!r}")
    return int(text)


def _digest(stated: str) -> tuple[str, bytes]:
    """Algorithm and bytes of a stated digest, written in hexadecimal or base32."""
    name, _, text = stated.rpartition(":")
    name = name.lower().replace("-", "") or "sha1"
    size = {"md5": 16, "sha1": 20, "sha256": 32, "sha512": 64}.get(name, 0)
    if re.fullmatch("[0-9A-Fa-f]*", text) and len(text) == (2 * size or len(text) // 2 * 2):
        return name, bytes.fromhex(text)
    try:
        return name, base64.b32decode(text.upper() + "=" * (-len(text) % 8))
    except ValueError:
        raise ValueError(f"digest {stated!r}") from None


def _agrees(stated: str | None, body: bytes) -> bool:
    """Whether the digest is that of the bytes; one of an unknown algorithm is not checked."""
    if not stated:
        return True
    name, value = _digest(stated)
    return name not in ("md5", "sha1", "sha256", "sha512") or hashlib.new(name, body).digest() == value


def _unchunked(body: bytes) -> bytes:
    """The bytes of a chunked HTTP body."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            raise ValueError("broken chunk")
        n = int(size, 16)
        if n == 0:
            return b"".join(out)
        if len(body) < end + 2 + n:
            raise ValueError("chunk cut short")
        out.append(body[end + 2:end + 2 + n])
        at = end + 4 + n


def _urn(page_id) -> str:
    return NO_ID if page_id is None else URN % quote(str(page_id), safe="")


def _page(urn: str) -> str | None:
    """The page id of our own records, else the record id as it stands, without brackets."""
    before, after = URN.split("%s")
    if urn == NO_ID:
        return None
    if urn.startswith(before) and urn.endswith(after):
        return unquote(urn[len(before):-len(after)])
    return urn.removeprefix("<").removesuffix(">")


def frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, decoded frame by frame with its dictionary."""
    view, at, dictionary = memoryview(archive), 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", view, 4)[0]
        body, at = bytes(view[8:8 + size]), 8 + size
        if len(body) != size:
            raise ValueError("dictionary frame cut short")
        if body[:4] == FRAME_MAGIC:  # the dictionary itself may be compressed
            body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
        dictionary = zstandard.ZstdCompressionDict(body)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(view):
        magic = struct.unpack_from("<I", view, at)[0] if at + 8 <= len(view) else 0
        if magic & 0xFFFFFFF0 == 0x184D2A50:  # any further skippable frame
            at += 8 + struct.unpack_from("<I", view, at + 4)[0]
            continue
        one, out = reader.decompressobj(), []
        while not one.eof:
            chunk = view[at:at + (1 << 16)]
            if not len(chunk):
                raise ValueError("frame cut short")
            out.append(one.decompress(chunk))
            at += len(chunk) - len(one.unused_data)
        yield b"".join(out)


def train_dictionary(payloads: DataFrame, column: str, samples: int = 256, sample_bytes: int = 16384,
                     size: int = 32768) -> bytes | None:
    """A dictionary from at most ``samples`` payloads of ``sample_bytes`` or less."""
    found = [r[0].encode() for r in payloads.select(column).where(
        F.octet_length(column).between(64, sample_bytes)).limit(samples).collect()]
    if len(found) < 16 or sum(map(len, found)) < 8 * size:
        return None
    return zstandard.train_dictionary(size, found, k=256, d=8).as_bytes()


def plan_records(pages: DataFrame, id_column: str, url: str, payload: str, revisit_bytes: int) -> DataFrame:
    """``(id, url, payload, digest, n_bytes, refers_to)`` of every row."""
    rows = pages.select(F.col(id_column).alias("id"), F.col(url).cast("string").alias("url"),
                        text_or_empty(payload).alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.encode("payload", "UTF-8"))).withColumn(
        "n_bytes", F.octet_length("payload").cast("long"))
    groups = written(rows.where(F.col("n_bytes") >= revisit_bytes).groupBy("digest", "n_bytes").agg(
        F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1").select("digest", "n_bytes", "keep"), "warc-groups")
    refers = F.when(~F.col("keep").eqNullSafe(F.col("id")), F.col("keep"))
    return rows.join(groups, ["digest", "n_bytes"], "left").select(
        "id", "url", "payload", "digest", "n_bytes", refers.alias("refers_to"))


def archives(pages: DataFrame, id_column: str = "page_id", url: str = "url", payload: str = "html",
             revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = 1 << 20, level: int = 3) -> DataFrame:
    """``(name, content)``: archives that hold a record for every row."""
    dictionary = train_dictionary(pages, payload)
    rows = plan_records(pages, id_column, url, payload, revisit_bytes)
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("content", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        writer = zstandard.ZstdCompressor(level=level, dict_data=own, write_checksum=True)
        lead = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary if dictionary else b""
        task, made, parts, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for page_id, link, body, digest, n, refers in zip(*(c.to_pylist() for c in batch.columns)):
                parts.append(writer.compress(record(page_id, link, body.encode(), digest, n, refers)))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([f"pages-{task:05d}-{made:05d}.warc.zst"]),
                                                      pa.array([lead + b"".join(parts)], pa.binary())], names=schema.names)
                    made, parts, size = made + 1, [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([f"pages-{task:05d}-{made:05d}.warc.zst"]),
                                              pa.array([lead + b"".join(parts)], pa.binary())], names=schema.names)

    return map_batches(rows, run, schema)


def parsed(archive: bytes, strict: bool) -> Iterator[tuple]:
    """The rows of ``RECORDS`` of an archive, one record at a time."""
    found = frames(archive)
    while True:
        try:
            raw = next(found, None)
        except (ValueError, zstandard.ZstdError, struct.error) as e:
            if strict:
                raise ValueError(f"broken frame: {e}") from e
            yield (*[None] * (len(RECORDS) - 1), f"broken frame: {e}")
            return
        if raw is None:
            return
        try:
            row = parse_record(raw)
        except ValueError as e:
            if strict:
                raise
            row = (*[None] * (len(RECORDS) - 1), str(e))
        yield row


def records(archives_: DataFrame, with_payload: bool = True, strict: bool = False) -> DataFrame:
    """A row of ``RECORDS`` for each record of the archives' ``content``; those that
    fail have their ``error``, or raise with ``strict``."""
    schema = T.StructType([f for f in RECORDS if with_payload or f.name != "payload"])
    at = RECORDS.names.index("payload")

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = dict(zip(RECORDS.names, zip(*rows)))
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], _ARROW[f.dataType.simpleString()]) for f in schema],
                                          names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for content in batch.column(0):
                for row in parsed(content.as_py(), strict):
                    size += 256 + (len(row[at] or b"") if with_payload else 0)
                    rows.append(row if with_payload else (*row[:at], None, *row[at + 1:]))
                    if size >= READ_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return map_batches(archives_.select("content").where(F.col("content").isNotNull()), run, schema)


_ARROW = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``(name, content)`` of ``.warc.zst`` files in any store that Spark reads."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("name"), "content")


def round_trip(pages: DataFrame, id_column: str = "page_id", **how) -> DataFrame:
    """Write the archives, read them back: ``(id, payload_bytes, payload_digest,
    record_type, refers_to)`` of every record."""
    kind = pages.schema[id_column].dataType
    back = records(written(archives(pages, id_column, **how), "warc", few=False), with_payload=False, strict=True)
    return back.select(F.col("record_id").cast(kind).alias(id_column), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"))
