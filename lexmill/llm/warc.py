"""WARC archives in Zstandard form, written from pages and read back.

An archive begins with a skippable frame that holds the compression dictionary; after it, each
record is a frame of its own. Tasks write archives to the shared folder under names of their own and
return a line for each; the table of those lines, committed by Spark, is the list of archives that
count. A file left by a task that was lost is on no list, so it is never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.texts import bounded_sample
from lexmill.session import materialize, scratch_path

# Frame magic numbers of the format and of dictionaries, little-endian.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
ZSTD_DICTIONARY = 0xEC30A437
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
PAGES = uuid.UUID("6c65786d-696c-8c00-8000-000000000000").int
LOW = (1 << 62) - 1
OWN_IDS = "<urn:uuid:6c65786d-696c-8c00-"


def filesystem(path: str):
    """(file system, path in it) for a path or URI that every executor can reach."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def record_id(page_id: int) -> str:
    """A record's id: the page's number in a fixed range of UUIDs."""
    return f"<urn:uuid:{uuid.UUID(int=PAGES | (page_id & LOW))}>"


def page_of(identifier: str) -> int:
    """The page's number; the inverse of `record_id` for numbers of 61 bits and a sign."""
    low = uuid.UUID(identifier.strip("<>").removeprefix("urn:uuid:")).int & LOW
    return low - (1 << 62) if low >> 61 else low


def train_dictionary(samples: list[bytes], size: int = 16_384) -> bytes:
    """A dictionary for the samples; empty if they are too few to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _safe(value: str) -> str:
    """A header value without spaces or control characters."""
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *[f"{k}: {v}".encode() for k, v in headers], f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response with the whole payload, or a revisit with its HTTP header alone."""
    sha1 = hashlib.sha1(payload).digest()
    own = record_id(page_id) if page_id is not None else f"<urn:uuid:{uuid.UUID(bytes=sha1[:16], version=4)}>"
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", own), ("WARC-Date", date),
        ("WARC-Target-URI", _safe(url) if url else "about:blank"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", record_id(refers_to))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _record(headers, http if refers_to is not None else http + payload)


class ArchiveWriter:
    """One archive at a time below `folder`; a new one begins after `roll_bytes`."""

    def __init__(self, folder: str, dictionary: bytes, roll_bytes: int, level: int, date: str):
        import zstandard

        self.fs, self.folder = filesystem(folder)
        self.dictionary, self.roll, self.date = dictionary, roll_bytes, date
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.zstd = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True, write_content_size=True)
        self.out, self.done = None, []

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.name = f"{self.folder}/{uuid.uuid4().hex}.warc.zst"
            self.out = self.fs.open_output_stream(self.name, compression=None)
            self.size = self.records = 0
            if self.dictionary:
                self._put(struct.pack("<II", DICTIONARY_FRAME, len(self.dictionary)) + self.dictionary)
            about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", self.date)]
            about.append(("Content-Type", "application/warc-fields"))
            self._put(self.zstd.compress(_record(about, b"software: lexmill\r\nformat: WARC File Format 1.1\r\n")))
        self._put(self.zstd.compress(record))
        self.records += 1
        if self.size >= self.roll:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.records, self.size))
            self.out = None


def revisits(pages: DataFrame, id_col: str, payload: str, least_bytes: int) -> DataFrame:
    """`pages` with `__refers_to`: the largest id with an equal payload, where that is another row's.

    Payloads below `least_bytes` and rows without an id are never revisits. Digests are counted in
    narrow rows combined before their shuffle; only those with several pages are joined back, and
    adaptive execution can split a payload with very many pages.
    """
    big = F.octet_length(payload) >= least_bytes
    keyed = pages.withColumn("__sha1", F.when(big & F.col(id_col).isNotNull(), F.sha1(payload)))
    heads = (
        keyed.where("__sha1 is not null")
        .groupBy("__sha1")
        .agg(F.max(id_col).alias("__head"), F.min(id_col).alias("__least"))
        .where("__head != __least")
        .select("__sha1", "__head")
    )
    # Rows that cannot match get keys of their own, so that they do not meet in one task.
    heads = materialize(heads, "warc-heads")
    own = F.concat(F.lit("-"), F.xxhash64(*[F.col(f"`{c}`") for c in pages.columns]).cast("string"))
    rows = keyed.withColumn("__sha1", F.coalesce("__sha1", own)).join(heads, "__sha1", "left")
    return rows.withColumn("__refers_to", F.when(F.col("__head") != F.col(id_col), F.col("__head"))).drop("__head", "__sha1")


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 1000,
    roll_bytes: int = 64 << 20,
    level: int = 3,
    dictionary_pages: int = 500,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write the pages and return the list of archives: path, records, bytes.

    Of equal payloads of at least `least_bytes`, the one with the largest id is stored and the
    others refer to it; rows that repeat that id are stored too. A null html is an empty payload, a
    null url is `about:blank`, and a row without an id is stored under an id of its own. An empty
    table gives no archives. The dictionary comes from the heads of at most `dictionary_pages` pages
    with the smallest hashes; it changes sizes, never contents. Ids have up to 61 bits and a sign.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"),
    )
    heads = rows.select("id", F.substring("payload", 1, 4096).alias("head"))
    few = bounded_sample(heads, F.struct("id", "head"), dictionary_pages).collect()
    dictionary = train_dictionary([bytes(r["head"]) for r in few if r["head"]])
    fs, inner = filesystem(folder)
    fs.create_dir(inner, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, dictionary, roll_bytes, level, date)
        for batch in batches:
            for page, url, payload, refers in zip(*(batch.column(i) for i in range(4)), strict=True):
                writer.add(page_record(page.as_py(), url.as_py(), payload.as_py(), refers.as_py(), date))
        writer.close()
        names, records, sizes = zip(*writer.done, strict=True) if writer.done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
            ["path", "records", "bytes"],
        )

    ready = revisits(rows, "id", "payload", least_bytes).select("id", "url", "payload", "__refers_to")
    listed = ready.mapInArrow(run, "path string, records long, bytes long")
    prefix = folder.split(inner)[0] if folder.endswith(inner) else ""
    return materialize(listed.withColumn("path", F.concat(F.lit(prefix), "path")), "warc-list")


def frames(read, chunk: int = 1 << 16) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each record frame of an archive; `read(n)` gives the next bytes.

    The dictionary comes from the leading skippable frame, plain or compressed; without one the
    frames stand alone. A frame must state its length and hold as much.
    """
    import zstandard

    data = read(8)
    dictionary, at = None, 0
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_FRAME:
        size = struct.unpack("<I", data[4:])[0]
        raw = read(size)
        if len(raw) != size:
            raise ValueError("the dictionary frame is cut short")
        magic = struct.unpack("<I", raw[:4])[0] if size >= 4 else 0
        if magic == ZSTD_FRAME:
            raw = zstandard.ZstdDecompressor().decompress(raw)
            magic = struct.unpack("<I", raw[:4])[0]
        if magic != ZSTD_DICTIONARY:
            raise ValueError("the leading frame holds no dictionary")
        dictionary, at, data = zstandard.ZstdCompressionDict(raw), 8 + size, b""
    zstd = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        data = data or read(chunk)
        if not data:
            return
        while len(data) < 18 and (more := read(chunk)):  # the longest frame header
            data += more
        stated = zstandard.get_frame_parameters(data).content_size
        frame, parts, used = zstd.decompressobj(), [], 0
        while not frame.eof:
            if not data and not (data := read(chunk)):
                raise ValueError(f"the frame at {at} is cut short")
            parts.append(frame.decompress(data))
            used += len(data)
            data = frame.unused_data if frame.eof else b""
        used -= len(data)
        content = b"".join(parts)
        if stated != len(content):
            raise ValueError(f"the frame at {at} states {stated} bytes and holds {len(content)}")
        yield at, content
        at += used


def parse_record(content: bytes) -> dict:
    """Header fields in lower case, block and payload of a record, after checking form and lengths."""
    head, found, rest = content.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in (VERSION, b"WARC/1.0"):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError(f"not a header line: {line[:80]!r}")
        fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    if missing := [k for k in REQUIRED if k not in fields]:
        raise ValueError(f"headers are missing: {missing}")
    if not fields["content-length"].isdecimal():
        raise ValueError("Content-Length is not a number")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {size}, the block has {len(rest) - 4} bytes")
    record = {"fields": fields, "type": fields["warc-type"], "block": rest[:size]}
    if record["type"] in ("response", "revisit"):
        http, found, body = record["block"].partition(b"\r\n\r\n")
        stated = [v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:]) if k.strip().lower() == b"content-length"]
        if not found or len(stated) != 1 or not stated[0].strip().isdigit():
            raise ValueError("the HTTP header has no length")
        record["payload_bytes"] = int(stated[0])
        kind, _, digest = fields.get("warc-payload-digest", "").partition(":")
        if kind != "sha1":
            raise ValueError("no SHA-1 payload digest")
        record["digest"] = base64.b32decode(digest).hex()
        if record["type"] == "response":
            if len(body) != record["payload_bytes"]:
                raise ValueError("the payload is not as long as its HTTP header says")
            if hashlib.sha1(body).hexdigest() != record["digest"]:
                raise ValueError("the payload does not match its digest")
            record["payload"] = body
        elif "warc-refers-to" not in fields or body:
            raise ValueError("a revisit must refer to a record and hold no payload")
    return record


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per response or revisit of the listed archives (a table with `path`).

    archive, offset, record_type, page_id, url, payload_bytes, payload_digest, refers_to[, payload].
    page_id is null for records whose id was not made from a page's. A record that breaks the format
    stops the job with its place. An archive is read as a stream, one record in memory at a time.
    """
    schema = (
        "archive string, offset long, record_type string, page_id long, url string, payload_bytes long, "
        "payload_digest string, refers_to long" + ", payload binary" * with_payload
    )
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

        def out(rows):
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, inner = filesystem(path)
                rows, held = [], 0
                with fs.open_input_stream(inner, compression=None, buffer_size=1 << 20) as stream:
                    for at, content in frames(stream.read):
                        try:
                            record = parse_record(content)
                        except ValueError as e:
                            raise ValueError(f"{path} at {at}: {e}") from e
                        if record["type"] not in ("response", "revisit"):
                            continue
                        fields = record["fields"]
                        own, other = fields["warc-record-id"], fields.get("warc-refers-to")
                        page = page_of(own) if own.startswith(OWN_IDS) else None
                        row = [
                            path, at, record["type"], page, fields.get("warc-target-uri"), record["payload_bytes"],
                            record["digest"], page_of(other) if other else None,
                        ]
                        rows.append([*row, record.get("payload")] if with_payload else row)
                        held += len(content) if with_payload else 200
                        if held > 1 << 24:
                            yield out(rows)
                            rows, held = [], 0
                yield out(rows)

    spark = archives.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return archives.select("path").repartition(tasks, "path").mapInArrow(run, schema)


def round_trip(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Write the pages, read the archives back."""
    return read_archives(write_archives(pages, **options), with_payload=False)
