"""WARC records in ZIP packages: writing, and range reads through the package's own directories.

A package is a ZIP of stored (uncompressed) members: `archive/data.warc.gz`, whose records are gzip members
of their own, and `indexes/index.cdxj`, one line for each record with its place. A reader finds the end record,
the ZIP64 records where sizes call for them, the central directory and each member's local header, and then
reads single records by offset and length; nothing is unpacked. Records are dealt to tasks by index entry,
so one large package is read by many.

Records with equal payloads of at least `MIN_REVISIT` bytes are stored once: that with the largest page_id is
the response, the others are revisits that refer to it.

Defined results: a null html is an empty payload; of repeated rows with the largest page_id each is a
response; records whose page_id is null are never referred to, though they may be revisits; a null url leaves out the target field;
an empty table gives one package without records or none. Pages of any length are written whole; a page and its compressed record
must fit into a task. Columns other than page_id, url and html are not written, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MIN_REVISIT = 1000
PACKAGE_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "1970-01-01T00:00:00Z"


# --- records ---------------------------------------------------------------------------------------------


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, size: int | None = None, date: str = DATE) -> bytes:
    """One WARC record: a response with its payload, or a revisit (refers_to is set) with the HTTP header alone."""
    size = len(payload) if size is None else size
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of a record; a response's digest and size are those of the payload that is there."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda x: x[len("<urn:page:") : -1] or None if x else None
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = int(next(line.split(b":")[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")))
    if fields["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['warc-record-id']}: payload and digest differ")
    return {
        "page_id": page(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": page(fields.get("warc-refers-to")),
    }


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


# --- packages --------------------------------------------------------------------------------------------


def read_directory(read_at, size: int) -> dict[str, tuple[int, int]]:
    """Place and length of every stored member's data. read_at(offset, length) reads a range of the file.

    The end record stands in the last 64 KiB; where one of its fields is all ones, the ZIP64 end record holds
    the value, and likewise a member's ZIP64 extra field.
    """
    tail_at = max(0, size - 65_557)
    tail = read_at(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory")
    _, _, _, _, count, length, offset, _ = struct.unpack("<4s4H2LH", tail[at : at + 22])
    if count == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        locator = read_at(tail_at + at - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end = read_at(struct.unpack("<Q", locator[8:16])[0], 56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, offset = struct.unpack("<3Q", end[32:56])
    directory, found, at = read_at(offset, length), {}, 0
    for _ in range(count):
        head = struct.unpack("<4s6H3L5H2L", directory[at : at + 46])
        if head[0] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, plain, n_name, n_extra, n_note, local = head[4], head[8], head[9], head[10], head[11], head[12], head[16]
        name = directory[at + 46 : at + 46 + n_name].decode()
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack("<2H", extra[:4])
            if kind == 1:
                wide = list(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                local = wide.pop(0) if local == 0xFFFFFFFF else local
            extra = extra[4 + n :]
        if method == 0:  # stored
            n_name, n_extra = struct.unpack("<2H", read_at(local + 26, 4))
            found[name] = (local + 30 + n_name + n_extra, packed)
        at += 46 + head[10] + head[11] + n_note
    return found


class _Package:
    """A package being written: records go into a stored member, the index follows."""

    def __init__(self, filesystem, path: str):
        self.out = filesystem.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(DATA, "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, page_id, record: bytes) -> None:
        data = gzip_member(record)
        self.member.write(data)
        self.index.append(json.dumps({"id": page_id, "offset": self.at, "length": len(data)}))
        self.at += len(data)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(INDEX, "".join(x + "\n" for x in self.index))
        self.zip.close()
        self.out.close()


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest and refers_to (null for responses).

    Which record a digest's others refer to is found from ids and digests alone. Pages meet the result by digest and page_id, so
    that the pages of a frequent payload are spread.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = common.Columns(pages, page_id="page_id", url="url", html="html").only()
    rows = rows.withColumn("payload_bytes", F.octet_length(payload).cast("long")).withColumn("payload_digest", F.sha1(payload))
    same = ["payload_digest", "payload_bytes"]
    ids = rows.where(F.col("payload_bytes") >= min_bytes).select("page_id", *same)
    copies = ids.groupBy(*same).agg(F.max("page_id").alias("_kept"), F.count(F.lit(1)).alias("_n")).where("_n > 1 AND _kept IS NOT NULL").drop("_n")
    others = ids.join(copies, same).where(~F.col("page_id").eqNullSafe(F.col("_kept")))
    others = others.groupBy(F.col("page_id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in same]).agg(F.max("_kept").alias("refers_to"))
    on = F.col("page_id").eqNullSafe(F.col("_id"))
    for c in same:
        on = on & (F.col(c) == F.col(f"_{c}"))
    return rows.join(others, on, "left").select("page_id", "url", "html", *same[::-1], "refers_to")


def write_packages(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes the pages' records below folder and returns the packages (path, records): a written table.

    A task that is run again writes packages of its own; only those in the returned table count.
    """

    def run(batches):
        filesystem, root = pafs.FileSystem.from_uri(folder)
        filesystem.create_dir(root, recursive=True)
        package, name, done = None, "", []
        for batch in batches:
            for r in batch.to_pylist():
                if package is None:
                    name = f"pages-{uuid.uuid4().hex}.zip"
                    package = _Package(filesystem, f"{root}/{name}")
                revisit = r["refers_to"] is not None
                data = b"" if revisit or r["html"] is None else r["html"].encode()
                package.add(r["page_id"], record_bytes(r["page_id"], r["url"], data, r["payload_digest"], r["refers_to"], r["payload_bytes"]))
                if package.at >= package_bytes:
                    package.close()
                    done.append((f"{folder}/{name}", len(package.index)))
                    package = None
        if package is not None:
            package.close()
            done.append((f"{folder}/{name}", len(package.index)))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], names=["path", "records"])

    return common.written(with_revisits(pages).mapInArrow(run, "path string, records long"), "packages")


def list_records(packages: DataFrame) -> DataFrame:
    """path, offset and length of every record, from the packages' directories and indexes."""

    def run(batches):
        for batch in batches:
            for path in batch["path"].to_pylist():
                filesystem, at = pafs.FileSystem.from_uri(path)
                with filesystem.open_input_file(at) as f:
                    read_at = lambda offset, length: f.read_at(length, offset)  # noqa: B023, E731
                    members = read_directory(read_at, f.size())
                    begin = members[DATA][0]
                    rows = [json.loads(x) for x in read_at(*members[INDEX]).splitlines()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(rows), pa.string()), pa.array([begin + x["offset"] for x in rows], pa.int64()), pa.array([x["length"] for x in rows], pa.int64())],
                    names=["path", "offset", "length"],
                )

    return packages.select("path").mapInArrow(run, "path string, offset long, length long")


def read_packages(spark: SparkSession, packages: DataFrame, id_type: str = "bigint") -> DataFrame:
    """The records' fields; each task reads its records by range."""

    def run(batches):
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        path, f = None, None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["path"] != path:
                    filesystem, at = pafs.FileSystem.from_uri(r["path"])
                    path, f = r["path"], filesystem.open_input_file(at)
                rows.append(parse_record(zlib.decompress(f.read_at(r["length"], r["offset"]), 31)))
            yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in rows], k) for n, k in zip(names, kinds)], names=names)

    width = common.shuffle_width(spark)
    places = list_records(packages).repartition(width, "path", F.floor(F.col("offset") / (8 << 20))).sortWithinPartitions("path", "offset")
    got = places.mapInArrow(run, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return got.withColumns({"page_id": F.col("page_id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})
