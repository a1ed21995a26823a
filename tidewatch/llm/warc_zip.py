"""Web archive packages: WARC records in ZIP files, read by ranges without extraction.

Package. A ZIP file with stored (uncompressed) members: ``archive/data.warc.gz`` holds one
gzip member per WARC record, ``indexes/index.cdxj`` one line per record with the record's
offset and length in the archive. A record can thus be read by itself.

Writing. Pages are grouped by the SHA-256 of their payload; in a group of equal payloads of
at least ``least_bytes`` the page of the largest id is written as a response, the others as
revisits that name it. Only groups of two or more are joined to the pages (broadcast after a
check of their number, else salted), so payloads are not shuffled. Each task streams its
pages into packages of about ``package_bytes`` or ``package_records`` (whose index lines it holds). A task that runs again writes other files,
and the list of packages, a table, names only those of tasks that ended well.

Reading. The end of a package is found from its last bytes; the central directory is parsed
from there, by the ZIP64 records where sizes, offsets or counts need them, in windows of
``WINDOW`` bytes. The stored archive members and the indexes are located by their local
headers. Index lines become rows (package, offset, length), which are dealt out by ranges of
``RANGE`` bytes; each task reads neighbouring records with one request of at most
``REQUEST`` bytes (or one record) and parses them. A package without an index is walked
from record to record.

Defined results. A null payload is empty; equal payloads are compared by their whole UTF-8
bytes (by hash). If several rows share the largest id of a group, all are responses. A null
id is the smallest; a group of null ids alone has responses only. Control characters and
blanks in a URL are percent-encoded, a null URL is left out. An empty table gives no
packages and no rows. Only the three named columns are read, so other columns never clash.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.joins import join_small
from tidewatch.session import scratch_path

from .common import saved

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
WINDOW, RANGE, REQUEST = 1 << 20, 32 << 20, 4 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # the table of pages has no times

Read = Callable[[int, int], bytes]  # offset, length


# -- files ------------------------------------------------------------------------------

def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; Spark also writes ``file:/...``."""
    if re.match(r"file:/", path):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def reader(path: str) -> tuple[Read, int]:
    """A function that reads ranges of a file, and the file's size."""
    store, inner = located(path)
    file = store.open_input_file(inner)
    return (lambda at, n: file.read_at(n, at)), file.size()


# -- records ----------------------------------------------------------------------------

def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, sha1: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{sha1}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None,
                date: str = DATE) -> bytes:
    """A response record, or a revisit record of page ``refers_to``, which has the header of
    the response but not its payload."""
    sha1 = payload_digest(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, sha1)}", f"WARC-Date: {date}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{sha1}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: quote(m[0], safe=""), url))
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to, sha1)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+):\w+>", urn or "")
    return int(found[1]) if found else None


def parse_record(raw: bytes) -> dict:
    """What a record says of its page. A response's digest and length are those of the
    payload that was read; ``intact`` tells whether its header states the same."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = fields(head)
    block = rest[:int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = warc.get("warc-payload-digest", "").removeprefix("sha1:")
    length = int(fields(http).get("content-length", 0))
    out = {"page_id": page_of(warc.get("warc-record-id")), "url": warc.get("warc-target-uri"),
           "record_type": warc["warc-type"], "refers_to": page_of(warc.get("warc-refers-to"))}
    if warc["warc-type"] == "revisit":
        return out | {"payload_bytes": length, "payload_digest": stated, "payload": None, "intact": True}
    sha1 = payload_digest(payload)
    return out | {"payload_bytes": len(payload), "payload_digest": sha1, "payload": payload,
                  "intact": sha1 == stated and len(payload) == length}


# -- packages: writing ------------------------------------------------------------------

class Package:
    """A package that is being written: records are streamed into the archive member, the
    index follows it."""

    def __init__(self, path: str):
        store, inner = located(path)
        store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.path, self.size, self.lines = path, 0, []
        self.out = store.open_output_stream(inner)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        # the size is not known before: the member may need ZIP64 fields
        self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)

    def add(self, record: bytes, page_id: int | None, url: str | None, mime: str) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # 31: a gzip member
        data = packer.compress(record) + packer.flush()
        self.member.write(data)
        self.lines.append((url or "", json.dumps({
            "url": url, "page": page_id, "mime": mime, "filename": ARCHIVE.rsplit("/", 1)[1],
            "offset": str(self.size), "length": str(len(data))})))
        self.size += len(data)

    def close(self) -> dict:
        self.member.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as index:
            for url, entry in sorted(self.lines):
                index.write(f"{quote(url, safe=':/?=&,')} {re.sub(r'[^0-9]', '', DATE)} {entry}\n".encode())
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        return {"package": self.path, "bytes": size, "records": len(self.lines)}


def write_packages(pages: DataFrame, path: str, least_bytes: int = 0, package_bytes: int = 256 << 20,
                   package_records: int = 100_000, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write ``pages`` as packages below ``path``; returns the list of packages (package,
    bytes, records), which is also a table there."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("same", F.sha2("payload", 256))
    slim = rows.select("page_id", "same", F.octet_length("payload").alias("n"))
    groups = (slim.filter(F.col("n") >= least_bytes).groupBy("same")
              .agg(F.max("page_id").alias("lead"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    groups = saved(groups, "warc-groups")
    rows = join_small(rows, groups, "same", "left", salt_cols=["page_id"])
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("lead")), F.col("lead"))

    def run(batches):
        package, done = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, refers_to = (batch.column(k)[i].as_py() for k in range(4))
                package = package or Package(f"{path}/packages/{uuid.uuid4().hex}.wacz")
                package.add(warc_record(page_id, url, payload, refers_to), page_id, url,
                            "text/html" if refers_to is None else "warc/revisit")
                if package.size >= package_bytes or len(package.lines) >= package_records:
                    done, package = [*done, package.close()], None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_pylist(done, schema=PACKAGES)

    listed = rows.select("page_id", "url", "payload", refers.alias("refers_to")).mapInArrow(
        run, "package string, bytes bigint, records bigint")
    listed.write.mode("overwrite").parquet(f"{path}/list")
    return read_list(spark, path)


PACKAGES = pa.schema([("package", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """The packages that ``write_packages`` has written below ``path``."""
    return spark.read.schema("package string, bytes bigint, records bigint").parquet(f"{path}/list")


# -- packages: the directory ------------------------------------------------------------

@dataclass(frozen=True)
class Member:
    name: str
    method: int     # 0: stored
    size: int       # as it stands in the file
    header: int     # offset of the local header


def directory_end(read: Read, size: int) -> tuple[int, int, int]:
    """Offset and length of the central directory, and by how much stated offsets are too
    small (bytes that were put before the archive)."""
    tail_at = max(0, size - (22 + 0xFFFF))
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\5\6")
    # a comment may hold the signature: the true record's comment ends with the file
    while at >= 0 and (len(tail) < at + 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\5\6", 0, at)
    if at < 0:
        raise ValueError("not a ZIP archive: no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = read(end - 20, 20) if end >= 20 else b""
        if locator[:4] == b"PK\6\7":
            (stated,) = struct.unpack_from("<Q", locator, 8)
            # the record stands right before its locator unless it has extra data
            for place in (stated, end - 20 - 56):
                record = read(place, 56) if 0 <= place <= end - 76 else b""
                if record[:4] == b"PK\6\6":
                    length, start = struct.unpack_from("<QQ", record, 40)
                    end = place
                    break
            else:
                raise ValueError("ZIP64 end of central directory not found")
    return end - length, length, end - length - start


def members(read: Read, size: int, window: int = WINDOW) -> Iterator[Member]:
    """The members, from the central directory, which is read in windows."""
    at, left, shift = directory_end(read, size)
    data = b""

    def more(n: int) -> None:
        """At least ``n`` bytes in ``data``."""
        nonlocal data, at, left
        while len(data) < n:
            if not left:
                raise ValueError("central directory ends within an entry")
            step = min(left, max(window, n - len(data)))
            got = read(at, step)
            if len(got) != step:
                raise ValueError("file ends within the central directory")
            data, at, left = data + got, at + step, left - step

    while data or left:
        more(46)
        if data[:4] != b"PK\1\2":
            raise ValueError("no central directory entry")
        method, _, _, _, packed, plain, n, m, k = struct.unpack_from("<HHHIIIHHH", data, 10)
        (header,) = struct.unpack_from("<I", data, 42)
        more(46 + n + m + k)
        flags, = struct.unpack_from("<H", data, 8)
        name = data[46:46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[46 + n:46 + n + m]
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == 1:  # ZIP64: only the values that the entry could not hold, in this order
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            extra = extra[4 + length:]
        data = data[46 + n + m + k:]
        yield Member(name, method, packed, header + shift)


def data_start(read: Read, member: Member) -> int:
    """Where a member's bytes begin: behind its local header, whose extra field may differ
    from the directory's."""
    head = read(member.header, 30)
    if head[:4] != b"PK\3\4":
        raise ValueError(f"{member.name}: no local header")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def member_lines(read: Read, member: Member, window: int = WINDOW) -> Iterator[bytes]:
    """Lines of a stored or deflated member, read in windows."""
    at, left, rest = data_start(read, member), member.size, b""
    if member.method not in (0, 8):
        raise ValueError(f"{member.name}: compression method {member.method}")
    inflate = zlib.decompressobj(-15) if member.method == 8 else None
    while left:
        data = read(at, min(window, left))
        if not data:
            raise ValueError(f"{member.name}: file ends within the member")
        at, left = at + len(data), left - len(data)
        *lines, rest = (rest + (inflate.decompress(data) if inflate else data)).split(b"\n")
        yield from lines
    if rest:
        yield rest


def walked(read: Read, start: int, size: int, window: int = WINDOW) -> Iterator[tuple[int, int]]:
    """(offset, length) of each gzip member of an archive, read from its beginning."""
    at, begin, inflate, data = 0, 0, zlib.decompressobj(31), b""
    while at < size or data:
        if not data:
            data = read(start + at, min(window, size - at))
            if not data:
                raise ValueError("file ends within the archive")
            at += len(data)
        inflate.decompress(data)
        data = inflate.unused_data
        if inflate.eof:
            yield begin, at - len(data) - begin
            begin, inflate = at - len(data), zlib.decompressobj(31)
    if begin != size:
        raise ValueError("the archive ends within a record")


def record_ranges(path: str) -> Iterator[tuple[int, int]]:
    """(offset in the package, length) of each record, by the indexes; without any, by
    walking the archives."""
    read, size = reader(path)
    found = list(members(read, size))
    archives = {m.name.rsplit("/", 1)[-1]: m for m in found
                if m.name.startswith("archive/") and m.name.endswith(".warc.gz")}
    for m in archives.values():
        if m.method:
            raise ValueError(f"{path}: {m.name} is not stored, its records have no ranges")
    starts = {name: data_start(read, m) for name, m in archives.items()}
    indexes = [m for m in found if m.name.startswith("indexes/") and m.name.endswith(".cdxj")]
    if not indexes:
        for name, m in archives.items():
            yield from ((starts[name] + at, n) for at, n in walked(read, starts[name], m.size))
    for index in indexes:
        for line in member_lines(read, index):
            entry = json.loads(line[line.index(b"{"):])
            at, n, m = int(entry["offset"]), int(entry["length"]), archives[entry["filename"]]
            if at < 0 or n <= 0 or at + n > m.size:
                raise ValueError(f"{path}: an index entry lies outside {m.name}")
            yield starts[entry["filename"]] + at, n


# -- packages: reading ------------------------------------------------------------------

def requests(ranges: list[tuple[int, int]], most: int = REQUEST) -> Iterator[list[tuple[int, int]]]:
    """Ranges in order of their offsets, neighbours together up to ``most`` bytes."""
    group: list[tuple[int, int]] = []
    for at, n in ranges:
        if group and (at != sum(group[-1]) or at + n - group[0][0] > most):
            yield group
            group = []
        group.append((at, n))
    if group:
        yield group


def sizes(packages: DataFrame) -> tuple[int, int]:
    """Number of packages and of ranges in them. The rows that are dealt out by them are
    tiny, so the number of tasks is stated: Spark would merge them by the rows' size."""
    n, total = packages.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    return max(1, min(n, 10_000)), max(1, -(-total // RANGE), packages.sparkSession.sparkContext.defaultParallelism)


def record_table(packages: DataFrame, tasks: int) -> DataFrame:
    """package, at, length: one row per record of the packages, from their directories and
    indexes."""
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple[int, int]] = []
                for found in record_ranges(path):
                    rows.append(found)
                    if len(rows) == 50_000:
                        yield table(path, rows)
                        rows = []
                yield table(path, rows)

    def table(path, rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int64()),
             pa.array([r[1] for r in rows], pa.int64())], names=["package", "at", "length"])

    paths = packages.select("package")
    return paths.repartition(tasks, "package").mapInArrow(run, "package string, at bigint, length bigint")


RECORD = {"page_id": "bigint", "url": "string", "record_type": "string", "refers_to": "bigint",
          "payload_bytes": "bigint", "payload_digest": "string", "intact": "boolean", "payload": "binary"}
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def read_records(packages: DataFrame, columns: tuple[str, ...] = tuple(RECORD)) -> DataFrame:
    """The records of ``packages``, each read by its range."""
    n_packages, n_ranges = sizes(packages)
    ranges = saved(record_table(packages, n_packages), "warc-ranges")
    dealt = (ranges.repartition(n_ranges, "package", F.floor(F.col("at") / RANGE))
             .sortWithinPartitions("package", "at"))
    schema = pa.schema([(c, _ARROW[RECORD[c]]) for c in columns])

    def run(batches):
        path, read = None, None
        for batch in batches:
            names = batch.column(0).to_pylist()
            ranges = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            first = 0
            for last in range(1, len(names) + 1):
                if last < len(names) and names[last] == names[first]:
                    continue
                if names[first] != path:
                    path = names[first]
                    read, _ = reader(path)
                for group in requests(ranges[first:last]):
                    start = group[0][0]
                    data = read(start, sum(group[-1]) - start)
                    found = [parse_record(zlib.decompress(data[at - start:at - start + n], 31)) for at, n in group]
                    yield pa.RecordBatch.from_pylist([{c: r[c] for c in columns} for r in found], schema=schema)
                first = last

    return dealt.mapInArrow(run, ", ".join(f"{c} {RECORD[c]}" for c in columns))
