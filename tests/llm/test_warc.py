import hashlib
import io
import struct

import pytest
import zstandard

from lexmill.llm import warc
from lexmill.session import scratch_path

SCHEMA = "page_id long, url string, html string, path string, payload string, records int"
BIG = "<html>" + "é x " * 500
ROWS = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, BIG), (4, "http://b/ ü\n1", "small"), (5, "http://b/2", "small"),
    (6, "", None), (7, "http://c", ""), (8, "http://c/8", "y" * 999), (9, "http://c/9", "y" * 999), (10, "http://c/10", "z" * 1000),
    (11, "http://c/11", "z" * 1000), (None, "http://n", BIG), (3, None, BIG), (12, "http://l", "<p>long</p>" * 300_000), (-5, "http://m", "w" * 2000),
    (-6, "http://m", "w" * 2000),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "p", "q", 1) for r in rows], SCHEMA)


def expected(rows):
    heads = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None and len(data) >= 1000:
            heads[data] = max(heads.get(data, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        head = heads.get(data)
        again = i is not None and head is not None and head != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", head if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("roll", [64 << 20, 2000])
def test_round_trip(spark, roll):
    listed = warc.write_archives(frame(spark).repartition(3), roll_bytes=roll)
    got = warc.read_archives(listed).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=repr) == expected(ROWS)
    assert {(r["page_id"], bytes(r["payload"]).decode()) for r in got if r["record_type"] == "response"} <= {(i, h or "") for i, _, h in ROWS}
    assert all(r["payload"] is None for r in got if r["record_type"] == "revisit")
    assert {r["url"] for r in got if r["page_id"] == 4} == {"http://b/%20ü%0A1"} and {r["url"] for r in got if r["page_id"] == 6} == {"about:blank"}
    assert listed.count() >= 3 and listed.agg({"records": "sum"}).first()[0] == len(ROWS)


def test_many_revisits(spark):
    rows = [(i, "http://x", BIG if i % 3 else f"{i}" * 900) for i in range(900)]
    got = warc.round_trip(spark, frame(spark, rows).repartition(5)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_dictionary_is_in_the_leading_frame(spark):
    rows = [(i, "http://x", f"<html><body><p>page {i} of many, all much alike</p></body></html>" * 40) for i in range(300)]
    path = warc.write_archives(frame(spark, rows), folder=scratch_path(spark, "warc")).first()["path"]
    fs, inner = warc.filesystem(path)
    data = fs.open_input_stream(inner, compression=None).read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.DICTIONARY_FRAME and struct.unpack("<I", data[8:12])[0] == warc.ZSTD_DICTIONARY
    raw = data[8 : 8 + size]
    packed = zstandard.ZstdCompressor().compress(raw)
    other = struct.pack("<II", warc.DICTIONARY_FRAME, len(packed)) + packed + data[8 + size :]
    assert [c for _, c in warc.frames(io.BytesIO(other).read)] == [c for _, c in warc.frames(io.BytesIO(data).read, 50)]


def archive(*records, dictionary=b""):
    zstd = zstandard.ZstdCompressor(write_content_size=True)
    return b"".join(zstd.compress(r) for r in records)


def test_broken_archives_are_refused():
    good = warc.page_record(1, "http://a", b"payload", None, "2024-01-01T00:00:00Z")
    assert warc.parse_record(good)["payload"] == b"payload"
    for bad in (
        good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"WARC-Date", b"X-Date"), good.replace(b"payload\r\n\r\n", b"paylo\r\n\r\n"),
        good.replace(b"\npayload", b"\npayloae"), good[:-1], good.replace(b"sha1:", b"md5:"), b"", good.replace(b"Content-Length: 7", b"Content-Length: 8"),
    ):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
    data = archive(good, good)
    assert len(list(warc.frames(io.BytesIO(data).read))) == 2
    with pytest.raises(ValueError):
        list(warc.frames(io.BytesIO(data[:-3]).read))
    with pytest.raises(ValueError):
        list(warc.frames(io.BytesIO(struct.pack("<II", warc.DICTIONARY_FRAME, 100) + b"short").read))
    unsized = zstandard.ZstdCompressor(write_content_size=False).compress(good)
    with pytest.raises(ValueError):
        list(warc.frames(io.BytesIO(unsized).read))


def test_ids():
    for page in (0, 1, -1, 2**61 - 1, -(2**61)):
        assert warc.page_of(warc.record_id(page)) == page


def test_empty_table(spark):
    listed = warc.write_archives(frame(spark, []))
    assert listed.count() == 0 and warc.read_archives(listed).count() == 0
