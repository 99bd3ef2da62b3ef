"""WARC records in ZIP packages, written by many tasks and read back by byte range.

A package holds stored (not compressed) members only: ``archive/pages.warc.gz``, one gzip
member per record, and ``indexes/index.cdxj``, one line per record with its place. So a record
is a byte range of the package itself. Reading parses the central directory (ZIP64 or not),
finds the stored members and their indexes, and deals the record ranges to tasks; nothing is
extracted, and a package of any size is read by as many tasks as its ranges make.

Packages lie in a folder that every executor reaches by ``pyarrow.fs`` (a shared mount, HDFS,
S3, GCS). Each task writes under names of its own; the manifest, an ordinary Spark table, names
the packages of tasks that ended well, so repeated or failed tasks leave no double records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, texts_of
from tidemark.session import shared_folder, stored

# A task begins another package beyond these; a range of records that one read takes.
PACKAGE_BYTES, PACKAGE_RECORDS, RANGE_BYTES = 1 << 30, 200_000, 8 << 20
RANGES_PER_TASK = 64
WARC_MEMBER, INDEX_MEMBER = "archive/pages.warc.gz", "indexes/index.cdxj"
# Fixed values of the formats.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, END64_PLACE, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
RECORD_ID = re.compile(r"<urn:page:(-?\d+)>\Z")
RANGES = "path string, member string, start long, stop long, records long, problem string"
RECORDS = ("path string, record_type string, page_id long, url string, refers_to long, payload_bytes long, "
           "payload_digest string, intact boolean, problem string, payload binary")


class Unreadable(Exception):
    """Bytes that are no stored member, index or record."""


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder as Spark names it."""
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(re.sub(r"\As3[an]:", "s3:", uri))


# --- Records --------------------------------------------------------------------------------

def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None,
                 date: str) -> bytes:
    """One record; a revisit holds the response's header but not its payload."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_name(page_id)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url:
        lines.append(f"WARC-Target-URI: {url}")
    if refers_to is None:
        block += payload
    else:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_name(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(stream) -> dict[str, str]:
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise Unreadable("a header ends with the data")
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of a WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise Unreadable("no record begins here")
        head = _headers(stream)
        try:
            size = int(head["content-length"])
        except (KeyError, ValueError):
            raise Unreadable("a record without a length") from None
        block = stream.read(size)
        if len(block) < size:
            raise Unreadable("a record is cut short")
        yield head, block


def record_row(head: dict[str, str], block: bytes, path: str, with_payload: bool) -> dict:
    """Digest and size of a response are those of its payload, a revisit's those it states."""
    kind, stated = head.get("warc-type"), head.get("warc-payload-digest", "").removeprefix("sha1:")
    payload, size = block, None
    if head.get("content-type", "").startswith("application/http"):
        web = io.BytesIO(block)
        web.readline()
        fields = _headers(web)
        payload = block[web.tell():]
        size = int(fields["content-length"]) if fields.get("content-length", "").isdigit() else None
    name, other = (RECORD_ID.match(head.get(h, "")) for h in ("warc-record-id", "warc-refers-to"))
    row = {"path": path, "record_type": kind, "page_id": int(name[1]) if name else None, "url": head.get("warc-target-uri"),
           "refers_to": int(other[1]) if other else None, "problem": None}
    if kind == "revisit":
        return row | {"payload_bytes": size, "payload_digest": stated or None, "intact": None, "payload": None}
    found = digest_of(payload)
    return row | {"payload_bytes": len(payload), "payload_digest": found, "intact": not stated or found == stated,
                  "payload": payload if with_payload else None}


# --- Writing --------------------------------------------------------------------------------

class _Package:
    """One package being written, front to back."""

    def __init__(self, folder: str):
        system, path = locate(folder)
        system.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        self.path, self.index, self.place = f"{folder}/{name}", [], 0
        self.stream = system.open_output_stream(f"{path}/{name}")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(WARC_MEMBER, "w", force_zip64=True)

    def add(self, record: bytes, url: str, date: str, line: dict) -> None:
        packed = gzip.compress(record, mtime=0)
        self.member.write(packed)
        entry = line | {"offset": self.place, "length": len(packed), "filename": WARC_MEMBER}
        self.index.append(f"{url or '-'} {re.sub('[^0-9]', '', date)} {json.dumps(entry)}\n".encode())
        self.place += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self.zip.open(INDEX_MEMBER, "w", force_zip64=True) as member:
            member.writelines(self.index)
        self.zip.close()
        self.stream.close()
        return self.path, len(self.index), self.place


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", revisit_from: int = 0, date: str = "1970-01-01T00:00:00Z",
          package_bytes: int = PACKAGE_BYTES, package_records: int = PACKAGE_RECORDS) -> DataFrame:
    """Writes one record per row into packages; returns the manifest (path, records, warc_bytes).

    Of records with equal payloads of at least ``revisit_from`` bytes those with the smallest
    id are responses, the others revisit it; equal means SHA-1. Rows that repeat the
    smallest id with that payload are all responses, rows of a group that has no id at all
    too; a row without id revisits a group that has one. A null payload is empty. Signs that
    cannot stand in a header line are percent-encoded in the URL; a null URL is left out.
    Empty tables make no package. Other columns are ignored.

    Groups are counted on the hash alone. Rows then meet the narrow table of groups with
    several rows: by broadcast while Spark finds it small, else by the hash, where a hot
    group's rows are split, as every group is one row on the other side.
    """
    folder = (folder or shared_folder(pages.sparkSession, "packages")).rstrip("/")
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    groups = rows.where(F.octet_length("payload") >= revisit_from).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    several = stored(groups.where("n > 1").select("digest", "first"), "payload-groups")
    refers = F.when(~F.equal_null("page_id", "first"), F.col("first")).alias("refers_to")
    typed = rows.join(several, "digest", "left").select("page_id", "url", "payload", "digest", refers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in in_slices(batches, "payload"):
            ids, urls, digests, others = (batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to"))
            for i, url, digest, other, text in zip(ids, urls, digests, others, texts_of(batch.column("payload"))):
                package = package or _Package(folder)
                url = quote(url or "", safe="%!#$&'()*+,/:;=?@[]~")
                named = base64.b32encode(bytes.fromhex(digest)).decode()
                package.add(record_bytes(i, url, text, named, other, date), url, date, {"page": i, "digest": f"sha1:{named}"})
                if package.place >= package_bytes or len(package.index) >= package_records:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_pydict({
            "path": pa.array([d[0] for d in done], pa.string()), "records": pa.array([d[1] for d in done], pa.int64()),
            "warc_bytes": pa.array([d[2] for d in done], pa.int64())})

    return stored(typed.mapInArrow(run, "path string, records long, warc_bytes long"), "manifest")


# --- Reading --------------------------------------------------------------------------------

@dataclass(frozen=True)
class Member:
    name: str
    method: int
    encrypted: bool
    size: int
    header: int


def _exactly(file, size: int, start: int) -> bytes:
    data = file.read_at(size, start) if start >= 0 else b""
    if len(data) < size:
        raise Unreadable("the file ends before its directory says")
    return data


def central_directory(file) -> list[Member]:
    """Members by the central directory; places are of the file, also behind foreign first bytes."""
    size = file.size()
    tail_at = max(0, size - 22 - 0xFFFF)
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(END)
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):
        at = tail.rfind(END, 0, at)  # these four bytes can stand in a comment
    if at < 0 or len(tail) - at < 22:
        raise Unreadable("no end of a central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    stop = tail_at + at
    place = file.read_at(20, stop - 20) if stop >= 20 else b""
    if place[:4] == END64_PLACE:
        stated, near = struct.unpack_from("<Q", place, 8)[0], stop - 20 - 56
        for stop in (stated, near):
            end = file.read_at(56, stop) if 0 <= stop <= size - 56 else b""
            if end[:4] == END64:
                count, length, start = struct.unpack_from("<QQQ", end, 32)
                break
        else:
            raise Unreadable("no ZIP64 end of a central directory")
    before = stop - length - start
    if before < 0:
        raise Unreadable("the central directory lies outside")
    data, members, at = _exactly(file, length, stop - length), [], 0
    for _ in range(count):
        if data[at:at + 4] != ENTRY or len(data) - at < 46:
            raise Unreadable("no entry in the central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, at = data[at + 46 + n_name:at + 46 + n_name + n_extra], at + 46 + n_name + n_extra + n_comment
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # ZIP64: those of the three that did not fit, in this order
                wide = list(struct.unpack_from(f"<{min(n, 24) // 8}Q", extra, 4))
                try:
                    plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                    packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                    header = wide.pop(0) if header == 0xFFFFFFFF else header
                except IndexError:
                    raise Unreadable("a ZIP64 field is missing") from None
            extra = extra[4 + n:]
        members.append(Member(name, method, bool(flags & 1), packed, header + before))
    return members


def member_start(file, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method or member.encrypted:
        raise Unreadable(f"{member.name} is not stored as it is")
    local = _exactly(file, 30, member.header)
    if local[:4] != LOCAL:
        raise Unreadable(f"no header before {member.name}")
    start = member.header + 30 + sum(struct.unpack_from("<HH", local, 26))
    if start + member.size > file.size():
        raise Unreadable(f"{member.name} is cut short")
    return start


class _Window(io.RawIOBase):
    """A byte range of a file as a stream."""

    def __init__(self, file, start: int, stop: int):
        self.file, self.at, self.stop = file, start, stop

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.file.read_at(min(len(buffer), self.stop - self.at), self.at)
        buffer[:len(data)] = data
        self.at += len(data)
        return len(data)


def _stream(file, start: int, stop: int):
    return io.BufferedReader(_Window(file, start, stop), 1 << 20)


def package_ranges(file, range_bytes: int = RANGE_BYTES) -> Iterator[tuple[str, int, int, int | None]]:
    """(member, start, stop, records) of neighbouring records; a member without index comes whole."""
    members = central_directory(file)
    places: dict[str, list[tuple[int, int]]] = {}
    for member in members:
        if member.name.startswith("indexes/") and member.name.endswith((".cdx", ".cdxj")):
            start = member_start(file, member)
            for line in _stream(file, start, start + member.size):
                if (at := line.find(b"{")) < 0:
                    continue
                try:
                    entry = json.loads(line[at:])
                    name, place = entry["filename"], (int(entry["offset"]), int(entry["length"]))
                except (ValueError, KeyError, TypeError):
                    raise Unreadable(f"a line of {member.name} names no place") from None
                places.setdefault(name.rpartition("/")[2], []).append(place)
    for member in members:
        short = member.name.rpartition("/")[2]
        if not (member.name.startswith("archive/") and short.endswith((".warc", ".warc.gz"))):
            continue
        start = member_start(file, member)
        if short not in places:
            yield member.name, start, start + member.size, None
            continue
        first = last = n = 0
        for offset, length in sorted(set(places[short])):
            if offset < last or length <= 0 or offset + length > member.size:
                raise Unreadable(f"the index names places outside {member.name}")
            if n and (offset != last or last - first + length > range_bytes):
                yield member.name, start + first, start + last, n
                n = 0
            first, last, n = (offset if not n else first), offset + length, n + 1
        if n:
            yield member.name, start + first, start + last, n


def _open(path: str):
    system, name = locate(path)
    return system.open_input_file(name)


def ranges(packages: DataFrame, path_col: str = "path", range_bytes: int = RANGE_BYTES, strict: bool = True) -> DataFrame:
    """The record ranges of packages, from directories and indexes alone.

    With ``strict`` an unreadable package fails the job; else it gives a row with its problem.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    with _open(path) as file:
                        found = [(path, *r, None) for r in package_ranges(file, range_bytes)]
                except (Unreadable, OSError, UnicodeDecodeError) as wrong:
                    if strict:
                        raise RuntimeError(f"{path}: {wrong}") from wrong
                    found = [(path, None, None, None, None, str(wrong))]
                yield _batch(found, RANGES)

    paths = packages.where(F.col(path_col).isNotNull()).select(path_col).distinct()
    return stored(paths.mapInArrow(run, RANGES), "ranges")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    columns = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(columns)],
                                      names=[name for name, _ in columns])


def read(packages: DataFrame, path_col: str = "path", with_payload: bool = False,
         range_bytes: int = RANGE_BYTES, strict: bool = True) -> DataFrame:
    """One row per record of the packages named in ``path_col``, each package once.

    ``payload_bytes`` and ``payload_digest`` (bare base32 SHA-1) are taken from the payload of a
    record, from a revisit's headers; ``intact`` says whether a payload has the digest its
    header states. Records of other writers have no ``page_id``. With ``strict`` unreadable
    bytes fail the job; else the rest of their range is one row with its ``problem``. No paths
    give an empty table. A record is held in memory as a whole.
    """
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.to_pylist():
                path, rows, held, seen = one["path"], [], 0, 0
                try:
                    if one["problem"]:
                        raise Unreadable(one["problem"])
                    with _open(path) as file:
                        stream = _stream(file, one["start"], one["stop"])
                        stream = gzip.GzipFile(fileobj=stream) if one["member"].endswith(".gz") else stream
                        for head, block in records(stream):
                            row = record_row(head, block, path, with_payload)
                            rows.append(tuple(row[n] for n in names))
                            seen, held = seen + 1, held + (len(block) if with_payload else 200)
                            if held >= range_bytes:
                                yield _batch(rows, RECORDS)
                                rows, held = [], 0
                    if one["records"] is not None and seen != one["records"]:
                        raise Unreadable(f"{seen} records where the index names {one['records']}")
                except (Unreadable, OSError, EOFError, zlib.error) as wrong:
                    if strict:
                        raise RuntimeError(f"{path}: {wrong}") from wrong
                    rows.append(tuple({"path": path, "problem": str(wrong)}.get(n) for n in names))
                if rows:
                    yield _batch(rows, RECORDS)

    found = ranges(packages, path_col, range_bytes, strict)
    # By number, as the rows of ranges are tiny and would be put together into one task.
    n, parts = found.count(), int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(n, max(parts, n // RANGES_PER_TASK)))
    rows = found.repartition(tasks, "path", "start").mapInArrow(run, RECORDS)
    return rows if with_payload else rows.drop("payload")


def round_trip(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back from packages."""
    return read(write(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT *, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first FROM p),
c AS (
  SELECT page_id, payload, first, list_transform(range(8), lambda i: ('0x' || substr(hex, (5 * i + 1)::INTEGER, 5))::INTEGER) AS twenty
  FROM h)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((twenty[(i // 4 + 1)::INTEGER] >> (5 * (3 - i % 4))::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM c
"""
