"""WARC archives compressed with a Zstandard dictionary (``.warc.zst``).

An archive starts with a skippable frame that holds its dictionary; then every record is a
Zstandard frame of its own, compressed with that dictionary. The dictionary is trained on
records of the same archive (evenly spread over it, ``sample_bytes`` at most), so a file is read
without any other. A task gathers ``archive_bytes`` of records, writes the archive and goes on.

Payloads of at least ``min_bytes`` bytes that are equal are stored once: the record with the largest page id is a
``response``, the others are ``revisit`` records that name it and carry digest and length of the
full payload. Smaller payloads all are responses.

Cases: null payloads are empty; null ids sort lowest and are written as ``null``; among rows equal in
payload and id one is the response; null urls become a URN of the record; line breaks in urls are
percent-encoded; an empty table writes no archive; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicgen.llm.common import cut, read, scratch_path, spread_files
from clinicgen.llm.files import create, open_stream

SKIPPABLE = 0x184D2A5D  # fixed value: frame magic of a dictionary in a .warc.zst file
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _urn(page_id: int | None, rid: int) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}:{rid}"


def page_record(page_id: int | None, rid: int, url: str | None, payload: bytes, sha1: str, refers: tuple[int | None, int] | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = (url or _urn(page_id, rid)).replace("\r", "%0D").replace("\n", "%0A")
    headers = [("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", f"<{_urn(page_id, rid)}>"), ("WARC-Date", date), ("WARC-Target-URI", target),
               ("WARC-Payload-Digest", f"sha1:{sha1}"), ("X-Payload-Length", str(len(payload))), ("Content-Type", "application/http;msgtype=response")]
    if refers:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_urn(*refers)}>")]
    return _record(headers, http if refers else http + payload)


def train_dictionary(records: list[bytes], size: int, sample_bytes: int) -> zstandard.ZstdCompressionDict:
    """A dictionary from records evenly spread over the archive; content alone where they are too few to train on."""
    total = sum(map(len, records))
    step = max(1, -(-total // sample_bytes))
    sample = records[::step]
    try:
        return zstandard.train_dictionary(size, sample)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(sample)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(path: str, records: list[bytes], dict_size: int, sample_bytes: int, level: int) -> int:
    """Writes one archive and returns its size."""
    dictionary = train_dictionary(records, dict_size, sample_bytes)
    raw = dictionary.as_bytes()
    compress = zstandard.ZstdCompressor(level=level, dict_data=dictionary).compress
    n = 0
    with create(path) as out:
        for frame in (struct.pack("<II", SKIPPABLE, len(raw)) + raw, *map(compress, records)):
            out.write(frame)
            n += len(frame)
    return n


class _Reader:
    def __init__(self, stream: Any) -> None:
        self.stream, self.held = stream, b""

    def fill(self, n: int) -> bool:
        parts, have = [self.held], len(self.held)
        while have < n:
            more = self.stream.read(max(1 << 18, n - have))
            if not more:
                break
            parts.append(more)
            have += len(more)
        self.held = b"".join(parts)
        return have >= n

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise ValueError("archive ends inside a record")
        out, self.held = self.held[:n], self.held[n:]
        return out

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.held.find(mark)) < 0:
            if not self.fill(len(self.held) + 1):
                if self.held:
                    raise ValueError("archive ends inside a header")
                return None
        return self.take(at + len(mark))


def read_archive(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, streamed; the dictionary comes from the leading frame."""
    with open_stream(path) as f:
        magic, n = struct.unpack("<II", f.read(8))
        if magic != SKIPPABLE:
            raise ValueError(f"{path}: no dictionary frame")
        dictionary = zstandard.ZstdCompressionDict(f.read(n))
        with zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(f, read_across_frames=True) as plain:
            reader = _Reader(plain)
            while (head := reader.until(b"\r\n\r\n")) is not None:
                lines = head.decode().split("\r\n")
                headers = dict(x.split(": ", 1) for x in lines[1:] if x)
                block = reader.take(int(headers["Content-Length"]))
                reader.take(4)
                yield headers, block


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = 32 << 20, dict_size: int = 112_640,
               sample_bytes: int = 4 << 20, level: int = 3, date: str = DATE) -> DataFrame:
    """Archives of all rows of ``pages`` (page_id, url, html); returns the manifest (file, n_records, n_bytes)."""
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = cut(pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"), F.monotonically_increasing_id().alias("rid"))
               .withColumn("sha", F.unhex(F.sha1("payload"))), "warc-rows")
    # only payloads that occur more than once need a partner: one small row each, however many copies
    held = (rows.where(F.octet_length("payload") >= min_bytes).groupBy(F.col("sha").alias("of"))
            .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "rid")).alias("first")).where("n > 1"))
    held = cut(held.select("of", "first"), "warc-repeats")
    large = F.octet_length("payload") >= min_bytes
    plan = rows.join(held, (F.col("sha") == F.col("of")) & large, "left").select(
        "page_id", "rid", "url", "payload", "sha",
        F.when(F.col("first.rid") != F.col("rid"), F.col("first.page_id")).alias("refers_id"),
        F.when(F.col("first.rid") != F.col("rid"), F.col("first.rid")).alias("refers_rid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            file = f"{path}/{uuid.uuid4().hex}.warc.zst"
            info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")],
                           b"format: WARC File Format 1.1\r\n")
            n = write_archive(file, [info, *records], dict_size, sample_bytes, level)
            return pa.RecordBatch.from_pydict({"file": [file], "n_records": [len(records)], "n_bytes": [n]})

        for b in batches:
            for page_id, rid, url, body, sha, rid_page, rid_row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                refers = None if rid_row is None else (rid_page, rid_row)
                r = page_record(page_id, rid, url, body, base64.b32encode(sha).decode(), refers, date)
                records.append(r)
                size += len(r)
                if size >= archive_bytes:
                    yield flush()
                    records, size = [], 0
        if records:
            yield flush()

    return cut(plan.mapInArrow(run, "file string, n_records bigint, n_bytes bigint"), "warc-manifest")


def _page(urn: str) -> int | None:
    page = urn.strip("<>").split(":")[2]
    return None if page == "null" else int(page)


def read_warc(manifest: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, html) from the archives; html is null for revisits.

    A response's payload is checked against its digest.
    """
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, html string"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file in b.column(0).to_pylist():
                rows, size = [], 0
                for h, block in read_archive(file):
                    kind = h["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    sha, n, html = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"]), None
                    if kind == "response":
                        body = block.split(b"\r\n\r\n", 1)[1]
                        n = len(body)
                        if digest(body) != sha:
                            raise ValueError(f"{file}: damaged payload of {h['WARC-Record-ID']}")
                        html = body.decode()
                    rows.append((_page(h["WARC-Record-ID"]), h["WARC-Target-URI"], n, sha, kind, _page(h["WARC-Refers-To"]) if kind == "revisit" else None, html))
                    size += len(block)
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kinds)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kinds)

    kinds = pa.schema([(c.split()[0], pa.int64() if c.endswith("bigint") else pa.string()) for c in schema.split(", ")])
    return spread_files(manifest.select("file"), "file").mapInArrow(run, schema)


def op3_warc_zst(spark, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return read_warc(write_warc(pages, scratch_path(spark, f"warc-{uuid.uuid4().hex}"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h, row_number() OVER () AS rid FROM pages),
r AS (SELECT *, first_value(page_id) OVER w AS first_page, row_number() OVER w AS k
      FROM p WINDOW w AS (PARTITION BY h ORDER BY page_id DESC NULLS LAST, rid)),
d AS (SELECT *, list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), lambda a, x: a || x) AS digest FROM r)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN first_page END AS refers_to FROM d
"""
