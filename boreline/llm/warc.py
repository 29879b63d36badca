"""WARC records in ZIP packages: writing, and range reads without extraction.

A package is a ZIP file with stored (uncompressed) members: ``archive/*.warc.gz``
with one gzip member per record, and ``indexes/*.cdxj`` with a line per record.
The reader needs three kinds of small reads: the end of the file for the
central directory (and its ZIP64 form), the index members, and the byte range
of each record that is asked for.

Packages are written by tasks into a shared folder, under names that no other
attempt uses. What counts is the manifest that Spark commits when the tasks
are done, so a lost executor leaves at most a file that nothing refers to.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boreline.llm.rows import drop_stored, table
from boreline.session import stored, work_path

#: A package is closed when it has so many record bytes or records; its index is held in memory until then.
PACKAGE_BYTES, PACKAGE_RECORDS = 64 << 20, 50_000
#: Payloads of at least so many bytes are written once.
REVISIT_BYTES = 1000
#: Records of so many bytes of a package are read by one task in a row.
READ_BYTES = 8 << 20

# Signatures and limits of the ZIP format, and the revisit profile of WARC 1.1.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    stored_size: int
    size: int
    header_at: int


def open_file(path: str) -> pa.NativeFile:
    system, place = pyarrow.fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def _at(file: pa.NativeFile, offset: int, size: int) -> bytes:
    data = file.read_at(size, offset)
    if len(data) != size:
        raise ValueError(f"file ends before {offset + size}")
    return data


def directory(file: pa.NativeFile) -> list[Member]:
    """The central directory, plain or ZIP64."""
    total = file.size()
    tail = min(total, 22 + FULL16)
    end = _at(file, total - tail, tail)
    at = end.rfind(END)
    while at >= 0 and at + 22 + struct.unpack_from("<H", end, at + 20)[0] != len(end):
        at = end.rfind(END, 0, at)  # the signature may occur in a comment
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    count, size, offset = struct.unpack_from("<HII", end, at + 10)
    place = total - tail + at
    if FULL16 == count or FULL32 in (size, offset):
        signature, _, record, _ = struct.unpack("<4sIQI", _at(file, place - 20, 20))
        if signature != LOCATOR64:
            raise ValueError("ZIP64 sizes without a locator")
        head = _at(file, record, 56)
        if head[:4] != END64:
            raise ValueError("no ZIP64 end of central directory where the locator says")
        count, size, offset = struct.unpack_from("<QQQ", head, 32)
    data, members, k = _at(file, offset, size), [], 0
    for _ in range(count):
        if data[k : k + 4] != ENTRY:
            raise ValueError(f"no central directory entry at {offset + k}")
        method, packed, plain, n_name, n_extra, n_comment, header = struct.unpack_from("<10xH8xIIHHH8xI", data, k)
        name = data[k + 46 : k + 46 + n_name].decode()
        extra = data[k + 46 + n_name : k + 46 + n_name + n_extra]
        plain, packed, header = _wide(extra, plain, packed, header)
        members.append(Member(name, method, packed, plain, header))
        k += 46 + n_name + n_extra + n_comment
    return members


def _wide(extra: bytes, *values: int) -> list[int]:
    """Values that are all ones stand, in this order, in the ZIP64 extra field."""
    k, wide = 0, b""
    while k + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, k)
        if kind == 1:
            wide = extra[k + 4 : k + 4 + size]
        k += 4 + size
    out, k = [], 0
    for value in values:
        if value == FULL32:
            if k + 8 > len(wide):
                raise ValueError("ZIP64 sizes are missing")
            value = struct.unpack_from("<Q", wide, k)[0]
            k += 8
        out.append(value)
    return out


def data_at(file: pa.NativeFile, member: Member) -> int:
    """Where a stored member's bytes begin; its local header tells how long that header is."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed in the package, so its records cannot be read by range")
    head = _at(file, member.header_at, 30)
    if head[:4] != LOCAL:
        raise ValueError(f"no local header of {member.name} at {member.header_at}")
    return member.header_at + 30 + sum(struct.unpack_from("<HH", head, 26))


def index_lines(file: pa.NativeFile, member: Member, part: int = 1 << 20) -> Iterator[str]:
    """The lines of an index member, read in parts."""
    start, rest = data_at(file, member), b""
    for k in range(0, member.size, part):
        *lines, rest = (rest + _at(file, start + k, min(part, member.size - k))).split(b"\n")
        yield from (x.decode() for x in lines if x)
    if rest:
        yield rest.decode()


def record(kind: str, page_id: int | None, url: str, payload: bytes, digest: bytes, refers_to: int | None, dated: str) -> bytes:
    """One WARC record as a gzip member; the same bytes for the same arguments."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block += payload if kind == "response" else b""
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:x-page:{page_id}>"),
        ("WARC-Date", dated),
        ("WARC-Target-URI", re.sub(r"\s", "%20", url)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest).decode()),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{refers_to}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 4, mtime=0)


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one record, gzipped or plain; field names in lower case."""
    if data[:2] == b"\x1f\x8b":
        data = zlib.decompress(data, 31)
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("the record is cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page(reference: str) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", reference)
    return int(found[1]) if found else None


class Package:
    """One ZIP package being written to a stream that cannot go back."""

    def __init__(self, path: str):
        self.path = path
        system, place = pyarrow.fs.FileSystem.from_uri(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.stream = system.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        # Sizes follow the data, wide enough for any length.
        self.member = self.zip.open(zipfile.ZipInfo("archive/data.warc.gz"), "w", force_zip64=True)
        self.index: list[str] = []
        self.at = 0

    def add(self, url: str, line: dict, data: bytes) -> None:
        self.member.write(data)
        self.index.append(f"{re.sub(r'\s', '%20', url)} {json.dumps(line | {'offset': self.at, 'length': len(data)})}\n")
        self.at += len(data)

    def full(self) -> bool:
        return self.at >= PACKAGE_BYTES or len(self.index) >= PACKAGE_RECORDS

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo("indexes/index.cdxj"), "".join(sorted(self.index)))
        self.zip.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps({"profile": "data-package", "resources": [{"path": "archive/data.warc.gz"}, {"path": "indexes/index.cdxj"}]}))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.index)


def write_packages(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", dated: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row; returns the manifest: ``path``, ``records``.

    Of rows with equal payloads of at least ``REVISIT_BYTES`` bytes, those with
    the largest key are responses (several, if rows repeat it), the others
    revisit it; a row without a key revisits too if another has one. Null
    payloads and URLs are empty. Other columns are ignored.
    """
    rows = pages.select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    # Counted within tasks first; only repeated payloads are joined, from a written table, so that AQE can split a hot one.
    latest = rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.max("id").alias("latest"), F.count(F.lit(1)).alias("n"))
    latest = stored(latest.where("n > 1 and latest is not null").select("digest", "latest"), "repeated-payloads")
    decided = rows.join(latest, "digest", "left").withColumn("refers_to", F.when(~F.col("id").eqNullSafe(F.col("latest")), F.col("latest")))

    def run(batches):
        from pyspark import TaskContext

        task, package, done = TaskContext.get(), None, []
        name = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}"

        def manifest():
            paths, counts = zip(*done, strict=True) if done else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], names=["path", "records"])

        for batch in batches:
            for k in range(batch.num_rows):
                page, url_, payload, digest, refers_to = (c[k].as_py() for c in batch.columns)
                if package is None:
                    package = Package(f"{name}-{len(done):03d}-{uuid.uuid4().hex[:8]}.wacz")
                kind = "response" if refers_to is None else "revisit"
                data = record(kind, page, url_, payload, digest, refers_to, dated)
                package.add(url_, {"id": page, "mime": "text/html" if kind == "response" else "warc/revisit", "digest": digest.hex(), "filename": "data.warc.gz"}, data)
                if package.full():
                    done.append(package.close())
                    package = None
        if package is not None:
            done.append(package.close())
        yield manifest()

    out = stored(decided.select("id", "url", "payload", "digest", "refers_to").mapInArrow(run, "path string, records bigint"), "manifest")
    drop_stored(pages.sparkSession, latest)
    return out


def _tasks(spark: SparkSession) -> int:
    """A row here stands for a file or a record: AQE, which sees small rows only, must not gather them into few tasks."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def locate(packages: DataFrame) -> DataFrame:
    """``path``, ``offset`` and ``length`` (in the package) of every record that the packages' indexes list."""

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_file(path) as file:
                    members = directory(file)
                    starts = {m.name.rpartition("/")[2]: data_at(file, m) for m in members if m.name.startswith("archive/") and m.size}
                    held: list[tuple[str, int, int]] = []
                    for member in members:
                        if member.name.startswith("indexes/") and member.name.endswith(".cdxj"):
                            for line in index_lines(file, member):
                                entry = json.loads(line[line.index("{") :])
                                held.append((path, starts[entry["filename"]] + int(entry["offset"]), int(entry["length"])))
                                if len(held) >= 10_000:
                                    yield _located(held)
                    if held:
                        yield _located(held)

    def _located(held):
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["path", "offset", "length"])
        held.clear()
        return out

    return packages.repartition(_tasks(packages.sparkSession), "path").select("path").mapInArrow(run, "path string, offset bigint, length bigint")


RECORD = "id bigint, record_type string, url string, payload_bytes bigint, payload_digest string, refers_to bigint, checked boolean"


def read_records(located: DataFrame, with_payload: bool = False) -> DataFrame:
    """Range-read the records and parse them.

    ``payload_bytes`` is the length of the full payload, of a revisit too;
    ``payload_digest`` is bare lower-case hex; ``checked`` tells whether a
    response's payload has that digest (null for revisits). Records that lie
    near each other in a package are read by one task, in order.
    """
    schema = RECORD + ", payload binary" * with_payload

    def run(batches):
        path, file = None, None
        for batch in batches:
            out: list[tuple] = []
            for place, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != path:
                    if file is not None:
                        file.close()
                    path, file = place, open_file(place)
                fields, http, payload = parse(_at(file, offset, length))
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
                whole = fields["warc-type"] == "response"
                row = (_page(fields["warc-record-id"]), fields["warc-type"], fields["warc-target-uri"], int(http["content-length"]), digest.hex(), _page(fields.get("warc-refers-to", "")), hashlib.sha1(payload).digest() == digest if whole else None)
                out.append(row + ((payload if whole else None),) * with_payload)
                if len(out) >= 500:
                    yield _batch(out)
            if out:
                yield _batch(out)
        if file is not None:
            file.close()

    def _batch(out):
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]
        names = [f.split()[0] for f in schema.split(", ")]
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds[: len(names)], strict=True)], names=names)
        out.clear()
        return made

    near = located.repartition(_tasks(located.sparkSession), "path", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("path", "offset")
    return near.select("path", "offset", "length").mapInArrow(run, schema)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_packages(table(spark, sf_dir, "pages"), work_path(spark, "warc"))
    read = read_records(locate(manifest))
    return read.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "checked")


ORACLE = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
latest AS (SELECT payload_digest, max(page_id) AS latest FROM p WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest, CASE WHEN p.page_id <> l.latest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id <> l.latest THEN l.latest END AS refers_to, CASE WHEN p.page_id <> l.latest THEN NULL ELSE true END AS checked
FROM p LEFT JOIN latest l ON p.payload_digest = l.payload_digest AND p.payload_bytes >= {REVISIT_BYTES}
"""
