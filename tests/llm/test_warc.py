import base64
import hashlib
import struct

import pytest
import zstandard

from cases import by_key, prose
from listenlens.llm import warc_zstd

LONG = "<html>" + prose(5, 400)
PAGES = [(1, "http://a.example/", "short"), (2, "http://a.example/", "short"), (3, None, None), (4, "x", ""),
         (5, "http://b/é\r\nX: y", LONG), (6, "http://b/2", LONG), (None, "http://b/3", LONG), (7, "c", "z" * 1000),
         (8, "c", "z" * 1000), (9, "c", "z" * 999), (10, "c", "z" * 999), (11, "d", "é" * 500), (11, "d", "é" * 500),
         (12, "e", "y" * 3_000_000), (13, "f", "\r\n\r\nWARC/1.1\r\n\r\n")]
SCHEMA = "page_id long, url string, html string, digest string, id string, n_bytes string, keep string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)


def brute(rows):
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        same = [j for j, _, x in rows if (x or "") == (h or "") and j is not None]
        keep = max(same, default=None) if len(raw) >= 1000 else None
        revisit = keep is not None and keep != i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    return out


def test_round_trip(spark):
    assert by_key(warc_zstd.round_trip(pages(spark, PAGES)).collect()) == by_key(brute(PAGES))
    assert warc_zstd.round_trip(pages(spark, [])).count() == 0


def test_files_with_dictionary(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"<html><body>{prose(i, 300)}</body></html>") for i in range(400)]
    made = warc_zstd.archives(pages(spark, rows), archive_bytes=50_000).collect()
    assert len(made) > 4 and len({r["name"] for r in made}) == len(made)
    for r in made:
        content = bytes(r["content"])
        magic, size = struct.unpack_from("<II", content)
        assert magic == 0x184D2A5D and content[8:12] == b"\x37\xa4\x30\xec"  # a dictionary's own magic
        plain = zstandard.ZstdDecompressor()
        with pytest.raises(zstandard.ZstdError):  # records need the dictionary
            plain.decompressobj().decompress(content[8 + size:])
        (tmp_path / r["name"]).write_bytes(content)
    back = warc_zstd.records(warc_zstd.read_files(spark, str(tmp_path))).collect()
    assert by_key((int(r["record_id"]), r["target"], bytes(r["payload"]).decode()) for r in back) == by_key(rows)


def archive(records, dictionary=None, lead=None):
    writer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    lead = lead if lead is not None else struct.pack("<II", 0x184D2A5D, len(dictionary)) + dictionary if dictionary else b""
    return lead + b"".join(writer.compress(r) for r in records)


def one(payload=b"hello", **change):
    return warc_zstd.record(1, "u", payload, change.get("digest", hashlib.sha1(payload).hexdigest()), change.get("n", len(payload)))


def test_reader_accepts_other_frames_and_compressed_dictionaries():
    samples = [prose(i, 200).encode() for i in range(300)]
    dictionary = zstandard.train_dictionary(8192, samples, k=256, d=8).as_bytes()
    packed = zstandard.ZstdCompressor().compress(dictionary)
    content = archive([one(), one(b"")], dictionary, struct.pack("<II", 0x184D2A5D, len(packed)) + packed)
    skip = struct.pack("<II", 0x184D2A51, 5) + b"other"
    assert [warc_zstd.parse_record(r)[4] for r in warc_zstd.frames(content + skip)] == [5, 0]
    assert list(warc_zstd.frames(archive([]))) == []


@pytest.mark.parametrize("raw", [
    one(digest="0" * 40), one(n=4), one()[:-1], one() + b"x", one().replace(b"WARC/1.1", b"HTTP/1.1"),
    one().replace(b"WARC-Record-ID", b"X-Record-ID"), one().replace(b"response\r\nWARC-Rec", b"revisit\r\nWARC-Rec"),
    one().replace(b"sha1:", b"sha1:!"), one().replace(b"Content-Length: 5", b"Content-Length: five"), b""])
def test_invalid_records_raise(raw):
    with pytest.raises(ValueError):
        warc_zstd.parse_record(raw)


def test_cut_archives_raise():
    content = archive([one(b"abc" * 100)])
    with pytest.raises(ValueError):
        list(warc_zstd.frames(content[:-3]))
    with pytest.raises(ValueError):
        list(warc_zstd.frames(struct.pack("<II", 0x184D2A5D, 50) + b"short"))


def foreign(kind, block, ident="<urn:uuid:8b7a>", mime="application/http; msgtype=response", **headers):
    lines = [f"WARC-TYPE: {kind}", f"warc-record-id: {ident}", "WARC-Date:2024-01-02T03:04:05Z", f"Content-Type: {mime}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items()] + [f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.0", *lines]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def base32(body, name="sha1"):
    return f"{name}:" + base64.b32encode(hashlib.new(name, body).digest()).decode().rstrip("=")


PAGE = b"<html>one</html>"
CHUNKED = b"HTTP/1.1 200 OK\r\ntransfer-encoding: Chunked\r\n\r\n6;x=1\r\n<html>\r\nA\r\none</html>\r\n0\r\n\r\n"
PLAIN = b"HTTP/1.1 200 OK\r\ncontent-length: 16\r\n\r\n" + PAGE
INFO = b"software: other\r\n"
SHA = hashlib.sha1(PAGE).hexdigest()


@pytest.mark.parametrize("raw, want", [
    (foreign("warcinfo", INFO, mime="application/warc-fields"), ("urn:uuid:8b7a", "warcinfo", None, INFO, hashlib.sha1(INFO).hexdigest(), None)),
    (foreign("metadata", INFO, mime="text/plain", WARC_Refers_To="<urn:uuid:1>"),
     ("urn:uuid:8b7a", "metadata", None, INFO, hashlib.sha1(INFO).hexdigest(), "urn:uuid:1")),
    (foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", mime="application/http;msgtype=request", WARC_Target_URI="http://a/\r\n b"),
     ("urn:uuid:8b7a", "request", "http://a/ b", b"", hashlib.sha1(b"").hexdigest(), None)),
    (foreign("response", PLAIN, WARC_Payload_Digest=base32(PAGE), WARC_Block_Digest=base32(PLAIN, "sha256")),
     ("urn:uuid:8b7a", "response", None, PAGE, SHA, None)),
    (foreign("response", CHUNKED, WARC_Payload_Digest=base32(PAGE)), ("urn:uuid:8b7a", "response", None, PAGE, SHA, None)),
    (foreign("response", PLAIN[:-4], WARC_Truncated="length", WARC_Payload_Digest=base32(PAGE)),
     ("urn:uuid:8b7a", "response", None, PAGE[:-4], hashlib.sha1(PAGE[:-4]).hexdigest(), None)),
    (foreign("revisit", b"", WARC_Payload_Digest=base32(PAGE)), ("urn:uuid:8b7a", "revisit", None, None, SHA, None))])
def test_records_of_other_writers(raw, want):
    ident, kind, target, payload, n, digest, refers, error = warc_zstd.parse_record(raw)
    assert (ident, kind, target, payload, digest, refers) == want and error is None
    assert n == (None if payload is None else len(payload))


@pytest.mark.parametrize("raw", [
    foreign("response", PLAIN, WARC_Payload_Digest=base32(b"other")), foreign("resource", INFO, WARC_Block_Digest=base32(b"other")),
    foreign("response", CHUNKED[:-20]), foreign("response", PLAIN[:-1]), foreign("response", CHUNKED, WARC_Payload_Digest=base32(INFO))])
def test_broken_records_of_other_writers_raise(raw):
    with pytest.raises(ValueError):
        warc_zstd.parse_record(raw)


def test_bad_records_become_errors(spark):
    good, bad = one(), one(digest="0" * 40)
    rows = [("a", archive([good, bad, foreign("warcinfo", INFO)])), ("b", archive([good, good])[:-3]), ("c", b"no archive"),
            ("d", b""), ("e", None)]
    made = spark.createDataFrame([(n, bytearray(c) if c is not None else None) for n, c in rows], "name string, content binary")
    got = warc_zstd.records(made).collect()
    assert sorted(r["record_type"] or "" for r in got) == ["", "", "", "response", "response", "warcinfo"]
    errors = [r for r in got if r["error"]]
    assert len(errors) == 3 and all(r["record_id"] is None and r["payload"] is None for r in errors)
    with pytest.raises(Exception, match="payload does not match its digest"):
        warc_zstd.records(made.where("name = 'a'"), strict=True).collect()


def test_string_ids(spark):
    ids = ["None", None, "a b>\r\nX: y", "é%20", ""]
    rows = spark.createDataFrame([(i, "u", "z" * 10) for i in ids], "page_id string, url string, html string")
    assert by_key((r["page_id"],) for r in warc_zstd.round_trip(rows).collect()) == by_key((i,) for i in ids)


def test_large_records_leave_in_batches(spark, monkeypatch):
    rows = [(i, "u", f"{i}" * 1000) for i in range(50)]
    monkeypatch.setattr(warc_zstd, "READ_BYTES", 3000)
    back = warc_zstd.records(warc_zstd.archives(pages(spark, rows))).collect()
    assert by_key((int(r["record_id"]), bytes(r["payload"]).decode()) for r in back) == by_key((i, h) for i, _, h in rows)
