"""Web archives in ZIP packages: written by Spark tasks, read back by byte ranges.

A package holds ``archive/data.warc.gz`` (one gzip member per WARC record), ``indexes/index.cdxj`` (place and
length of each record) and ``datapackage.json``, all stored, not compressed again, so that any record
is a byte range of the package.

``write``: rows with equal payloads (SHA-256) of at least ``min_revisit_bytes`` bytes are one record of type
``response``, that of the smallest id, and otherwise ``revisit`` records that name it and carry no payload. The
smallest id is found by aggregates: per (digest, salt of the id), then per digest, and goes back to the rows by
(digest, salt), so copies of one payload spread over ``SALTS`` places. Each task writes packages
of about ``package_bytes`` under names of its own attempt; a manifest that Spark commits with the
job lists those that count, so lost or repeated attempts leave no trace in what is read.

``read``: one task per package reads its last bytes, the end record (the ZIP64 one too), the central directory and
the local headers of its stored members, then the index, and yields ranges of consecutive records. The ranges are
dealt out anew and read by offset; a package is never unpacked, and no task holds more than one range (``RANGE_BYTES``, or one
record). An archive member without index entries is walked once, record by record. Archive members that
are compressed in the ZIP cannot be read by range and are an error that names the package.

Files are reached by ``pyarrow.fs`` (local and mounted folders, HDFS, S3, GCS, Azure).

Null payloads are empty ones. Ids travel as text in the record id; rows without id come last when the smallest is
looked for, and are read back without id. Of rows that repeat id, URL and payload one is the response. Addresses are
percent-encoded where they hold other than printable ASCII; a null one is left out. An empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import urllib.parse
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panewise.llm.common import column_bytes, map_arrow

SALTS = 64
PACKAGE_BYTES, RANGE_BYTES = 64 << 20, 1 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fixed values of the ZIP format: signatures of its records, the id of the ZIP64 field.
LOCAL, CENTRAL, END, END64, LOCATOR64, FIELD64 = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7", 1


def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder and its path there."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_uri(url: str) -> str:
    return urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~")


def sort_key(url: str | None) -> str:
    """The index key of an address: its host from the last part on, then the rest."""
    parts = urllib.parse.urlsplit(header_uri(url or "")) if "[" not in (url or "") else None
    if not parts or not parts.netloc:
        return header_uri(url or "-") or "-"
    host, rest = parts.netloc.lower().rsplit("@", 1)[-1], parts.path + ("?" + parts.query if parts.query else "")
    return ",".join(reversed(host.removeprefix("www.").split("."))) + ")" + (rest or "/")


# ---------------------------------------------------------------- writing


def record(kind: str, record_id: str, date: str, content_type: str, block: bytes, **fields: str | None) -> bytes:
    """One WARC record; ``fields`` are further headers, with ``_`` for ``-``."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    lines += [f"WARC-{name.replace('_', '-')}: {value}" for name, value in fields.items() if value is not None]
    lines += [f"Content-Type: {content_type}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def page_record(page_id: str | None, url: str | None, payload: bytes, first: tuple[str | None, str | None] | None, date: str) -> tuple[bytes, str]:
    """The record of a page and its payload digest; ``first`` is the (id, url) it repeats."""
    digest = base32_sha1(payload)
    name = lambda i: f"urn:x-page:{urllib.parse.quote(i or '', safe='')}:{digest}"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = {"Target_URI": header_uri(url) if url is not None else None, "Payload_Digest": f"sha1:{digest}"}
    kind, block = "response", head + payload
    if first is not None:
        kind, block = "revisit", head
        fields |= {"Profile": PROFILE, "Refers_To": f"<{name(first[0])}>", "Refers_To_Date": date}
        fields["Refers_To_Target_URI"] = header_uri(first[1]) if first[1] is not None else None
    return record(kind, name(page_id), date, "application/http; msgtype=response", block, **fields), digest


class _Stream:
    """What the ZIP writer needs of a file that only grows."""

    def __init__(self, stream):
        self.write, self.flush = stream.write, stream.flush


class Package:
    """A ZIP package in the making; records go straight to the file."""

    def __init__(self, stream, date: str, software: str = "panewise"):
        self.stream = stream
        self.zip = zipfile.ZipFile(_Stream(stream), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.size, self.records, self.lines, self.sha256 = 0, 0, [], hashlib.sha256()
        info = f"software: {software}\r\nformat: WARC File Format 1.1\r\n".encode()
        self._append(gzip.compress(record("warcinfo", f"urn:uuid:{uuid.uuid4()}", date, "application/warc-fields", info), mtime=0))

    def _append(self, data: bytes) -> None:
        self.member.write(data)
        self.sha256.update(data)
        self.size += len(data)

    def add(self, data: bytes, key: str, date: str, level: int, **entry) -> None:
        packed = gzip.compress(data, level, mtime=0)
        place = {"offset": str(self.size), "length": str(len(packed)), "filename": ARCHIVE.rsplit("/", 1)[1]}
        self.lines.append(f"{key} {re.sub('[^0-9]', '', date)} {json.dumps(entry | place)}\n")
        self._append(packed)
        self.records += 1

    def close(self) -> int:
        """Write index and description; the number of records."""
        self.member.close()
        index = "".join(sorted(self.lines)).encode()
        self.zip.writestr(zipfile.ZipInfo(INDEX), index)
        parts = [(ARCHIVE, self.sha256.hexdigest(), self.size), (INDEX, hashlib.sha256(index).hexdigest(), len(index))]
        resources = [{"name": p.rsplit("/", 1)[1], "path": p, "hash": f"sha256:{h}", "bytes": n} for p, h, n in parts]
        self.zip.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": resources}))
        self.zip.close()
        self.stream.close()
        return self.records


def with_first(pages: DataFrame, id_col: str, url_col: str, body_col: str, min_revisit_bytes: int) -> DataFrame:
    """(id, url, body, first_id, first_url, repeats) for every row; the first are the smallest id of its payload."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(body_col).cast("string"), F.lit("")).alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256)).withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "url")
    salted = rows.groupBy("digest", "salt").agg(F.min(rank).alias("least"))
    firsts = salted.groupBy(F.col("digest").alias("of")).agg(F.min("least").alias("first"))
    firsts = salted.join(firsts, F.col("digest") == F.col("of")).select(F.col("digest").alias("of"), F.col("salt").alias("at"), "first")
    same = rows.join(firsts, (F.col("digest") == F.col("of")) & (F.col("salt") == F.col("at")))
    copy = F.row_number().over(Window.partitionBy("digest", "salt", "id", "url").orderBy("digest"))
    same = same.withColumn("copy", copy)
    new = F.col("first.id").eqNullSafe(F.col("id")) & F.col("first.url").eqNullSafe(F.col("url")) & (F.col("copy") == 1)
    repeats = ~new & (F.octet_length("body") >= min_revisit_bytes)
    return same.select(F.col("id").cast("string").alias("id"), "url", "body", F.col("first.id").cast("string").alias("first_id"), F.col("first.url").alias("first_url"), repeats.alias("repeats"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", date: str = "2024-01-01T00:00:00Z", min_revisit_bytes: int = 0, package_bytes: int = PACKAGE_BYTES, level: int = 6) -> None:
    """Write every row of ``pages`` as a record into ZIP packages below the shared folder ``path``, and their manifest."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = open_folder(path)
        system.create_dir(folder, recursive=True)
        prefix = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        names, counts, open_one = [], [], None

        def finish():
            counts.append(open_one.close())

        for batch in batches:
            ids, urls, first_ids, first_urls, repeats = (batch.column(c).to_pylist() for c in ("id", "url", "first_id", "first_url", "repeats"))
            for i, payload in enumerate(column_bytes(batch.column("body"))):
                if open_one is None:
                    names.append(f"{prefix}-{len(names):04d}.wacz")
                    open_one = Package(system.open_output_stream(f"{folder}/{names[-1]}"), date)
                data, digest = page_record(ids[i], urls[i], payload, (first_ids[i], first_urls[i]) if repeats[i] else None, date)
                kind = {"mime": "warc/revisit"} if repeats[i] else {"mime": "text/html", "status": "200"}
                open_one.add(data, sort_key(urls[i]), date, level, url=header_uri(urls[i] or ""), digest=f"sha1:{digest}", **kind)
                if open_one.size >= package_bytes:
                    finish()
                    open_one = None
        if open_one is not None:
            finish()
        yield pa.record_batch({"package": pa.array(names, pa.string()), "records": pa.array(counts, pa.int64())})

    rows = with_first(pages, id_col, url_col, body_col, min_revisit_bytes)
    map_arrow(rows, store, "package string, records long").write.parquet(f"{path}/manifest")


# ---------------------------------------------------------------- reading


class Member(NamedTuple):
    name: str
    method: int
    crc32: int
    packed: int
    size: int
    header: int


def _end_record(file, size: int) -> tuple[int, int, int]:
    """(entries, bytes, start) of the central directory."""
    tail_size = min(size, 22 + 0xFFFF + 20)
    tail = file.read_at(tail_size, size - tail_size)
    at = len(tail)
    while (at := tail.rfind(END, 0, at)) >= 0:
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] <= len(tail):
            break
    if at < 0:
        raise ValueError("not a ZIP file: no end record")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    end = size - tail_size + at
    if at >= 20 and tail[at - 20 : at - 16] == LOCATOR64:
        (place,) = struct.unpack_from("<Q", tail, at - 12)
        record64 = file.read_at(56, place) if place + 56 <= size else b""
        if record64[:4] != END64:  # bytes put before the archive shift all places
            place = end - 20 - 56
            record64 = file.read_at(56, place)
        if record64[:4] != END64:
            raise ValueError("broken ZIP64 end record")
        entries, length, start = struct.unpack_from("<QQQ", record64, 32)
        end = place
    if end - length < 0:
        raise ValueError("broken central directory")
    return entries, length, start


def directory(file, size: int) -> list[Member]:
    """The members of a ZIP file that its central directory lists; ``file`` has ``read_at(n, offset)``."""
    entries, length, start = _end_record(file, size)
    data = file.read_at(length, start) if start + length <= size else b""
    out, at = [], 0
    for _ in range(entries):
        if data[at : at + 4] != CENTRAL or at + 46 > len(data):
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        crc, packed, whole, n, m, k = struct.unpack_from("<IIIHHH", data, at + 16)
        (header,) = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        field, last = at + 46 + n, at + 46 + n + m
        while field + 4 <= last:
            kind, width = struct.unpack_from("<HH", data, field)
            if kind == FIELD64:  # holds, in this order, those numbers that are all ones in the fixed part
                wide = iter(struct.unpack_from(f"<{width // 8}Q", data, field + 4))
                whole = next(wide) if whole == 0xFFFFFFFF else whole
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            field += 4 + width
        out.append(Member(name, method, crc, packed, whole, header))
        at = last + k
    return out


def data_start(file, member: Member) -> int:
    """Where the bytes of a member start, behind its local header."""
    head = file.read_at(30, member.header)
    if head[:4] != LOCAL:
        raise ValueError(f"broken local header of {member.name}")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def indexed(lines: bytes) -> dict[str, list[tuple[int, int]]]:
    """(offset, length) of the records of each archive file in an index."""
    out: dict[str, list[tuple[int, int]]] = {}
    for line in lines.splitlines():
        if (at := line.find(b"{")) >= 0 and not line.startswith(b"!"):
            entry = json.loads(line[at:])
            out.setdefault(entry.get("filename", ""), []).append((int(entry["offset"]), int(entry["length"])))
    return out


def walked(file, start: int, size: int, packed: bool) -> Iterator[tuple[int, int]]:
    """(offset, length) of each record of an archive member, read through once."""
    at = 0
    while at < size:
        done = 0
        if packed:
            unpack = zlib.decompressobj(31)
            while not unpack.eof:
                if at + done >= size:
                    raise ValueError("archive ends within a record")
                piece = file.read_at(min(RANGE_BYTES, size - at - done), start + at + done)
                unpack.decompress(piece)
                done += len(piece) - len(unpack.unused_data)
        else:
            head = b""
            while (end := head.find(b"\r\n\r\n")) < 0:
                if at + len(head) >= size:
                    raise ValueError("archive ends within a record")
                head += file.read_at(min(4096, size - at - len(head)), start + at + len(head))
            done = end + 8 + int(_fields(head[:end])["content-length"])
        yield at, done
        at += done


def locate(file, size: int) -> Iterator[tuple[int, list[int]]]:
    """Ranges of consecutive records of a package: (start in the package, length of each record)."""
    members = directory(file, size)
    places: dict[str, list[tuple[int, int]]] = {}
    for m in members:
        if m.name.startswith("indexes/") and re.search(r"\.(cdxj?|cdxj?\.gz)$", m.name):
            data = file.read_at(m.packed, data_start(file, m))
            data = data if m.method == zipfile.ZIP_STORED else zlib.decompress(data, -15)
            for name, found in indexed(gzip.decompress(data) if m.name.endswith(".gz") else data).items():
                places.setdefault(name, []).extend(found)
    for m in members:
        if not re.search(r"(^|/)[^/]+\.warc(\.gz)?$", m.name):
            continue
        if m.method != zipfile.ZIP_STORED:
            raise ValueError(f"{m.name} is compressed in the package, so its records are no byte ranges")
        start = data_start(file, m)
        found = sorted(set(places.get(m.name.rsplit("/", 1)[-1]) or walked(file, start, m.size, m.name.endswith(".gz"))))
        first, end, lengths = 0, 0, []
        for offset, length in found:
            if offset + length > m.size or offset < 0:
                raise ValueError(f"the index points outside {m.name}")
            if lengths and (offset != end or end - first + length > RANGE_BYTES):
                yield start + first, lengths
                lengths = []
            if not lengths:
                first = end = offset
            lengths.append(length)
            end += length
        if lengths:
            yield start + first, lengths


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def parsed(data: bytes) -> tuple[dict[str, str], bytes, int | None]:
    """Headers of a record, its payload, and the length of the payload that an HTTP header in it states."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    end = data.index(b"\r\n\r\n")
    fields = _fields(data[:end])
    block = data[end + 4 : end + 4 + int(fields["content-length"])]
    if not fields.get("content-type", "").startswith("application/http"):
        return fields, block, None
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    return fields, payload, int(stated[1]) if stated else None


RECORDS = "package string, offset long, record_type string, record_id string, target_uri string, warc_date string, payload_digest string, payload_bytes long, refers_to string, intact boolean"


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every indexed record of the packages that the manifest below ``path`` lists.

    ``payload_digest`` is that of the header, without its prefix. ``payload_bytes`` is the length read, for revisits that of
    the payload they repeat (as their HTTP header states). ``intact``: the payload read has the digest; null for revisits.
    """
    return read_packages(spark.read.parquet(f"{path}/manifest").select(F.concat(F.lit(path.rstrip("/") + "/"), "package").alias("package")), with_payload)


def read_packages(packages: DataFrame, with_payload: bool = True) -> DataFrame:
    """As ``read``, over the packages whose addresses are in the one column of ``packages``."""
    kind = RECORDS + (", payload binary" if with_payload else "")
    n = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, place = open_folder(uri)
                with system.open_input_file(place) as file:
                    try:
                        for start, lengths in locate(file, file.size()):
                            yield pa.record_batch({"package": [uri], "start": [start], "lengths": pa.array([lengths], pa.list_(pa.int64()))})
                    except (ValueError, KeyError, struct.error, StopIteration, zlib.error) as e:
                        raise ValueError(f"{uri}: {e}") from e

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start, lengths in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                system, place = open_folder(uri)
                with system.open_input_file(place) as file:
                    data = file.read_at(sum(lengths), start)
                rows, at = [], 0
                for length in lengths:
                    fields, payload, stated = parsed(data[at : at + length])
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    again = fields.get("warc-type") == "revisit"
                    row = {"package": uri, "offset": start + at, "record_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id", "").strip("<>")}
                    row |= {"target_uri": fields.get("warc-target-uri"), "warc_date": fields.get("warc-date"), "payload_digest": digest, "payload_bytes": stated if again else len(payload)}
                    row |= {"refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None, "intact": None if again or not digest else base32_sha1(payload) == digest}
                    rows.append(row | ({"payload": payload} if with_payload else {}))
                    at += length
                yield pa.RecordBatch.from_pylist(rows, schema)

    fields = [("package", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("intact", pa.bool_())]
    schema = pa.schema(fields + ([("payload", pa.binary())] if with_payload else []))
    ranges = map_arrow(packages.repartition(n, packages.columns[0]), find, "package string, start long, lengths array<long>")
    return ranges.repartition(n, "package", "start").mapInArrow(fetch, kind)
