"""Web archive packages: ZIP and ZIP64 directories, ranges, edge rows."""

import base64
import hashlib
import io
import struct
import zipfile
import zlib

import pytest

from tidewatch.llm import warc_zip as wz
from tidewatch.session import scratch_path

SCHEMA = "page_id bigint, url string, html string, payload string, same string, lead bigint"


def ranged(data: bytes):
    asked = []

    def read(at, n):
        asked.append(n)
        return data[at:at + n]

    return read, asked


def zipped(files, comment=b"", deflate=()):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in files.items():
            z.writestr(name, data, zipfile.ZIP_DEFLATED if name in deflate else zipfile.ZIP_STORED)
        z.comment = comment
    return out.getvalue()


def test_directory_equals_the_library():
    files = {f"archive/é{i}.bin": bytes([i]) * (i * 37) for i in range(60)}
    plain = zipped(files, comment=b"a PK\5\6 inside the comment")
    for data in (plain, b"#!/bin/sh\n" + plain):  # bytes before the archive
        read, _ = ranged(data)
        for window in (46, 1 << 20):
            found = list(wz.members(read, len(data), window))
            assert [m.name for m in found] == list(files)
            for m in found:
                start = wz.data_start(read, m)
                assert m.method == 0 and data[start:start + m.size] == files[m.name]


def test_zip64_counts_sizes_and_offsets():
    many = io.BytesIO()
    with zipfile.ZipFile(many, "w") as z:  # more members than the short record can count
        for i in range(66_000):
            z.writestr(str(i), b"")
    read, asked = ranged(many.getvalue())
    assert sum(1 for _ in wz.members(read, len(many.getvalue()))) == 66_000
    assert max(asked) <= wz.WINDOW

    # an entry that states size and offset beyond 32 bits only in its ZIP64 field
    name, body = b"archive/big", b"payload"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20)
    local += name + struct.pack("<HHQQ", 1, 16, len(body), len(body))
    extra = struct.pack("<HHQQQ", 1, 24, 5_000_000_000, 5_000_000_000, 0)
    entry = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name),
                        len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    start = len(local + body)
    record = struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(entry), start)
    locator = struct.pack("<4sIQI", b"PK\6\7", 0, start + len(entry), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    for before in (b"", b"more bytes"):
        data = before + local + body + entry + record + locator + end
        read, _ = ranged(data)
        (member,) = wz.members(read, len(data))
        assert (member.name, member.size) == ("archive/big", 5_000_000_000)
        assert data[wz.data_start(read, member):].startswith(body)


@pytest.mark.parametrize("data", [b"", b"PK", b"x" * 100, zipped({"a": b"b"})[:-5]])
def test_no_archive(data):
    with pytest.raises(ValueError):
        list(wz.members(ranged(data)[0], len(data)))


def gz(data):
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def test_without_index_deflated_index_and_bad_members(tmp_path):
    records = [gz(wz.warc_record(i, "http://a/ b", b"p" * i)) for i in range(5)]
    want, at = [], 0
    for r in records:
        want.append((at, len(r)))
        at += len(r)
    index = "".join(f'k 1 {{"filename":"data.warc.gz","offset":"{a}","length":"{n}"}}\n' for a, n in want).encode()
    assert list(wz.walked(ranged(b"".join(records))[0], 0, at, window=7)) == want

    def ranges(files, **more):
        (tmp_path / "x.wacz").write_bytes(zipped(files, **more))
        return list(wz.record_ranges(str(tmp_path / "x.wacz")))

    whole = ranges({wz.ARCHIVE: b"".join(records)})
    assert [(a - whole[0][0], n) for a, n in whole] == want
    assert ranges({wz.ARCHIVE: b"".join(records), wz.INDEX: index}, deflate=[wz.INDEX]) == whole
    with pytest.raises(ValueError):  # records of a deflated archive have no ranges
        ranges({wz.ARCHIVE: b"".join(records)}, deflate=[wz.ARCHIVE])
    with pytest.raises(ValueError):  # an index that points outside
        ranges({wz.ARCHIVE: records[0], wz.INDEX: index})


def test_record_round_trip():
    got = wz.parse_record(wz.warc_record(-7, "http://a/\r\nX: 1", "é\r\n\r\nx".encode()))
    assert got["page_id"] == -7 and got["url"] == "http://a/%0D%0AX:%201" and got["intact"]
    assert got["payload"] == "é\r\n\r\nx".encode() and got["record_type"] == "response"
    got = wz.parse_record(wz.warc_record(None, None, b"abc", refers_to=9))
    assert (got["page_id"], got["url"], got["refers_to"], got["payload_bytes"]) == (None, None, 9, 3)
    broken = wz.warc_record(1, "u", b"abc").replace(b"\r\n\r\nabc", b"\r\n\r\nabd")
    assert not wz.parse_record(broken)["intact"]


def test_requests_join_neighbours():
    assert list(wz.requests([(0, 5), (5, 5), (11, 4), (15, 100), (115, 1)], most=12)) == [
        [(0, 5), (5, 5)], [(11, 4)], [(15, 100)], [(115, 1)]]


def expected(rows, least=0):
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        group = [i for i, _, h in rows if (h or "") == (html or "")]
        lead = max((i for i in group if i is not None), default=None)
        revisit = len(group) > 1 and page_id != lead and len(body) >= least
        out.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if revisit else "response", lead if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize(("least", "size", "count"), [(0, 256 << 20, 100_000), (5, 3000, 9)])
def test_pages_equal_plain_version(spark, least, size, count):
    rows = [(i, f"http://h/{i}", f"page {i % 17}" * (i % 5)) for i in range(120)]
    rows += [(500, None, None), (501, "u", ""), (None, "v", "page 3"), (None, "w", "only null ids"),
             (None, "w", "only null ids"), (502, "é\n", "x" * 2_000_000), (3, "http://h/3", rows[3][2]),
             (503, "u", "twice"), (503, "u", "twice")]
    df = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], SCHEMA).repartition(5)
    packages = wz.write_packages(df, scratch_path(spark, "packages"), least, size, count)
    assert packages.agg({"records": "sum"}).first()[0] == len(rows)
    got = wz.read_records(packages).collect()
    assert all(r["intact"] for r in got)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[c] for c in cols) for r in got), key=str) == expected(rows, least)
    by_id = {r[0]: r for r in rows}
    assert all(r["payload"].decode() == (by_id[r["page_id"]][2] or "") for r in got
               if r["record_type"] == "response" and r["page_id"] is not None)


def test_empty_table(spark):
    packages = wz.write_packages(spark.createDataFrame([], SCHEMA), scratch_path(spark, "packages"))
    assert wz.read_records(packages).collect() == []
