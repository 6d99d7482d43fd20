import base64
import hashlib
import struct

import pytest
import zstandard

from clinicgen.llm import warc as W

SCHEMA = "page_id bigint, url string, html string, payload string, rid int"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 3) for i, u, h in rows], SCHEMA)


def expect(rows, least=0):
    """record per row: (page_id, bytes, digest, type, refers_to), by the largest id per payload."""
    out = []
    best, named = {}, {}
    for k, (i, _, h) in enumerate(rows):
        rank = (i is not None, i if i is not None else 0)
        if h not in best or rank > best[h][0]:
            best[h] = (rank, k)
            named[h] = i
    for k, (i, _, h) in enumerate(rows):
        b = (h or "").encode()
        sha = base64.b32encode(hashlib.sha1(b).digest()).decode()
        first = best[h][1] == k or len(b) < least
        out.append((i, len(b), sha, "response" if first else "revisit", None if first else named[h]))
    return sorted(out, key=str)


ROWS = [(i, f"http://x/{i}", f"<html>{i % 7} é {'p ' * (i % 3)}</html>") for i in range(60)] + \
       [(100, None, ""), (101, "http://a\r\nb: c", ""), (None, "u", "null id"), (None, "u", "other"), (7, "again", "x" * 300_000), (8, "u", "x" * 300_000), (9, "u", "\r\n\r\nWARC/1.1\r\n\r\n")]


@pytest.mark.parametrize("archive_bytes", [1, 4000, 32 << 20])
def test_round_trip(lspark, tmp_path, archive_bytes):
    m = W.write_warc(table(lspark, ROWS).repartition(3), f"file:{tmp_path}/w", archive_bytes=archive_bytes)
    out = W.read_warc(m).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str) == expect(ROWS)
    html = {r.page_id: r.html for r in out if r.html is not None}
    assert html[7] if 7 in html else html[8] == "x" * 300_000
    assert html[9] == ROWS[-1][2]
    for f in m.collect():
        raw = open(f.file.removeprefix("file:"), "rb").read()
        magic, n = struct.unpack("<II", raw[:8])
        assert magic == 0x184D2A5D
        d = zstandard.ZstdCompressionDict(raw[8:8 + n])
        rest, records = raw[8 + n:], 0
        while rest:  # every record is a frame of its own
            o = zstandard.ZstdDecompressor(dict_data=d).decompressobj()
            assert o.decompress(rest).startswith(b"WARC/1.1\r\n")
            rest, records = o.unused_data, records + 1
        assert records == f.n_records + 1


def test_nulls_are_empty_and_ties_have_one_response(lspark, tmp_path):
    rows = [(1, "u", None), (2, "u", ""), (5, "u", "same"), (5, "u", "same"), (None, "u", "same")]
    out = W.read_warc(W.write_warc(table(lspark, rows), f"{tmp_path}/t")).collect()
    same = [r for r in out if r.payload_bytes == 4]
    assert sorted(r.record_type for r in same) == ["response", "revisit", "revisit"]
    assert all(r.refers_to == 5 for r in same if r.record_type == "revisit")
    assert {(r.page_id, r.record_type, r.refers_to) for r in out if not r.payload_bytes} == {(2, "response", None), (1, "revisit", 2)}
    small = W.read_warc(W.write_warc(table(lspark, rows), f"{tmp_path}/s", min_bytes=5)).collect()
    assert {r.record_type for r in small} == {"response"}


def test_empty_table(lspark, tmp_path):
    assert W.read_warc(W.write_warc(table(lspark, []), f"{tmp_path}/e")).count() == 0
