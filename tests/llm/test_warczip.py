"""Web archives in ZIP packages: the reader against the standard library's writer, and round trips."""

import base64
import gzip
import hashlib
import io
import json
import zipfile

import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from panewise.llm import entries, warczip


class Bytes:
    """A file in memory as the reader sees it; notes how much is read."""

    def __init__(self, data):
        self.data, self.seen = data, 0

    def read_at(self, n, offset):
        self.seen += len(out := self.data[offset : offset + n])
        return out


def packed(members, comment=b"", before=b"", method=zipfile.ZIP_STORED, streamed=False):
    out = io.BytesIO()
    with zipfile.ZipFile(warczip._Stream(out) if streamed else out, "w", method) as z:
        for name, data in members.items():
            z.writestr(zipfile.ZipInfo(name) if method == zipfile.ZIP_STORED else name, data)
        z.comment = comment
    return before + out.getvalue()


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("streamed", [False, True])
@pytest.mark.parametrize("comment", [b"", b"PK\5\6 is no end record", b"x" * 65535])
def test_directory_as_the_library_reads_it(monkeypatch, zip64, streamed, comment):
    if zip64:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 40)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    members = {"a.txt": b"a" * 100, "empty": b"", "dir/é.bin": bytes(range(256)), "z": b"1"}
    data = packed(members, comment, streamed=streamed)
    assert (b"PK\6\6" in data) == zip64
    file = Bytes(data)
    found = warczip.directory(file, len(data))
    plain = packed(members, streamed=streamed)  # the library takes the comment's signature for an end record
    with zipfile.ZipFile(io.BytesIO(plain)) as z:
        assert [(m.name, m.method, m.crc32, m.packed, m.size, m.header) for m in found] == [(i.filename, i.compress_type, i.CRC, i.compress_size, i.file_size, i.header_offset) for i in z.infolist()]
    for m in found:
        at = warczip.data_start(file, m)
        assert data[at : at + m.size] == members[m.name]


def test_what_is_no_zip_file_is_an_error():
    for data in (b"", b"PK\5\6", b"x" * 70000):
        with pytest.raises(ValueError):
            warczip.directory(Bytes(data), len(data))
    good = packed({"a": b"x"})
    with pytest.raises(ValueError):
        warczip.directory(Bytes(good.replace(b"PK\1\2", b"PK\1\3")), len(good))
    with pytest.raises(ValueError):
        list(warczip.locate(f := Bytes(packed({"archive/x.warc": b"WARC/1.1"}, method=zipfile.ZIP_DEFLATED)), len(f.data)))


def some_records(n):
    out = []
    for i in range(n):
        data, _ = warczip.page_record(str(i), f"http://h{i % 3}.example/é {i}", b"<p>%d</p>" % i * (i + 1), None, "2024-01-01T00:00:00Z")
        out.append(data)
    return out


@pytest.mark.parametrize("zipped", [False, True])
@pytest.mark.parametrize("index", ["cdxj", "cdx.gz", None])
def test_records_of_foreign_packages(monkeypatch, zipped, index):
    """Archive members with and without index, zipped record by record or not; only ranges are read."""
    monkeypatch.setattr(warczip, "RANGE_BYTES", 2000)
    records = some_records(40)
    stored = [gzip.compress(r) if zipped else r for r in records]
    name = "data.warc" + ".gz" * zipped
    places, at = [], 0
    for r in stored:
        places.append((at, len(r)))
        at += len(r)
    lines = "".join(f"com,example)/ 2024 {json.dumps({'offset': o, 'length': str(n), 'filename': name})}\n" for o, n in reversed(places)).encode()
    members = {f"archive/{name}": b"".join(stored), "pages/pages.jsonl": b"x" * 100_000}
    if index:
        members[f"indexes/index.{index}"] = gzip.compress(lines) if index.endswith("gz") else lines
    file = Bytes(packed(members, before=b""))
    got = []
    for start, lengths in warczip.locate(file, len(file.data)):
        assert sum(lengths) <= 2000 or len(lengths) == 1
        for n in lengths:
            got.append(file.data[start : start + n])
            start += n
    assert got == stored
    if index:
        assert file.seen < 75_000 + len(members[f"indexes/index.{index}"])  # the end of the file, the directory and the index
    fields, payload, stated = warczip.parsed(got[7])
    assert payload == b"<p>7</p>" * 8 and stated == len(payload) and fields["warc-target-uri"] == "http://h1.example/%C3%A9%207"


def test_index_beyond_the_member_is_an_error():
    line = b'x 2024 {"offset": "0", "length": "99", "filename": "a.warc"}\n'
    data = packed({"archive/a.warc": b"WARC/1.1", "indexes/index.cdxj": line})
    with pytest.raises(ValueError):
        list(warczip.locate(Bytes(data), len(data)))


def test_sort_keys():
    assert warczip.sort_key("https://www.Example.com/a?b=1") == "com,example)/a?b=1"
    assert warczip.sort_key("http://x.org") == "org,x)/"
    assert warczip.sort_key(None) == "-" and warczip.sort_key("no address") == "no%20address" and warczip.sort_key("http://[") == "http://["


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark, frame, tmp_path):
    body = "<p>same text</p>"
    rows = [(i, f"http://a.example/{i}", body if i % 3 == 0 else f"<p>{i}</p>" * (i % 40)) for i in range(-5, 400)]
    rows += [(900, "u", None), (901, None, ""), (902, "http://b.example/\r\nWARC-Type: x", "é中\x00 \r\n\r\n"), (903, "u", "long " * 400_000)]
    rows += [(None, "n1", body), (None, "n2", "only without id"), (None, "n3", "only without id"), (904, "u", "twice"), (904, "u", "twice"), (904, "v", "twice"), (904, "v", "other text")]
    df = frame(rows, "page_id long, url string, html string", extra=("id", "digest", "first"))
    path = f"file:{tmp_path}/out"
    warczip.write(df, path, package_bytes=2000)
    out = warczip.read(spark, path)
    got = out.withColumn("page_id", entries.page_of("record_id")).withColumn("to", entries.page_of("refers_to")).collect()
    assert len(got) == len(rows) and out.select("package").distinct().count() > 3
    assert all(r.intact for r in got if r.record_type == "response") and all(r.intact is None for r in got if r.record_type == "revisit")
    text = {digest(t): (t or "").encode() for _, _, t in rows}
    assert all(r.payload == (text[r.payload_digest] if r.record_type == "response" else b"") and r.payload_bytes == len(text[r.payload_digest]) for r in got)
    least = {}
    for i, _, t in rows:
        least[digest(t)] = min(least.get(digest(t), 10**9), 10**9 if i is None else i)
    want = sorted((i or -1, digest(t)) for i, _, t in rows)
    assert sorted((r.page_id or -1, r.payload_digest) for r in got) == want
    for r in got:
        first = None if least[r.payload_digest] == 10**9 else least[r.payload_digest]
        if r.record_type == "revisit":
            assert r.to == first and (r.refers_to.rsplit(":", 1)[1] == r.payload_digest)
        else:
            assert r.page_id == first
    responses = [r.payload_digest for r in got if r.record_type == "response"]
    assert len(responses) == len(set(responses)) == len(text)
    # orphans of lost attempts are in no manifest
    system, folder = warczip.open_folder(path)
    with system.open_output_stream(f"{folder}/part-00000-lost-0000.wacz") as f:
        f.write(b"half a file")
    assert warczip.read(spark, path, with_payload=False).count() == len(rows)


def test_small_payloads_are_all_responses(spark, frame, tmp_path):
    rows = [(i, "u", t) for i, t in enumerate(["ab", "ab", "abc", "abc", "éé", "éé"])]
    path = f"{tmp_path}/out"
    warczip.write(frame(rows, "page_id long, url string, html string"), path, min_revisit_bytes=3)
    got = sorted((entries_id, r.record_type) for r in warczip.read(spark, path).withColumn("i", entries.page_of("record_id")).collect() for entries_id in [r.i])
    assert got == [(0, "response"), (1, "response"), (2, "response"), (3, "revisit"), (4, "response"), (5, "revisit")]


def test_empty_table_and_packages_of_the_library(spark, frame, tmp_path):
    empty = frame([], "page_id long, url string, html string")
    warczip.write(empty, f"{tmp_path}/none")
    assert warczip.read(spark, f"{tmp_path}/none").count() == 0
    warczip.write(frame([(1, "http://x.example/a", "<p>")], "page_id long, url string, html string"), f"{tmp_path}/one")
    names = [f.path for f in pyarrow.fs.LocalFileSystem().get_file_info(pyarrow.fs.FileSelector(f"{tmp_path}/one")) if f.path.endswith(".wacz")]
    with zipfile.ZipFile(names[0]) as z:
        assert z.testzip() is None and z.namelist() == [warczip.ARCHIVE, warczip.INDEX, "datapackage.json"]
        described = {r["path"]: r for r in json.loads(z.read("datapackage.json"))["resources"]}
        for name in (warczip.ARCHIVE, warczip.INDEX):
            assert described[name]["hash"] == "sha256:" + hashlib.sha256(z.read(name)).hexdigest()
        assert gzip.decompress(z.read(warczip.ARCHIVE)).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    packages = spark.createDataFrame([(f"file://{names[0]}",)], "package string")
    assert [r.payload for r in warczip.read_packages(packages).collect()] == [b"<p>"]
    assert warczip.read_packages(packages.limit(0)).count() == 0


def test_query_on_a_whole_table(spark):
    got = sorted(map(tuple, entries.op12_warc_archive(spark, "/root/testdata/sf0.001").collect()))
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").orderBy("page_id").collect()
    first, want = {}, []
    for p in pages:
        t = p.html or ""
        one = first.setdefault(t, p.page_id)
        want.append((p.page_id, len(t.encode()), digest(t), "response" if one == p.page_id else "revisit", None if one == p.page_id else one))
    assert got == want


def test_large_group_of_copies_is_spread(frame):
    rows = [(i, "u", "same") for i in range(2000)]
    df = warczip.with_first(frame(rows, "page_id long, url string, html string"), "page_id", "url", "html", 0)
    assert df.filter(~F.col("repeats")).select("id").collect() == [("0",)] and df.filter("repeats AND first_id = '0'").count() == 1999
