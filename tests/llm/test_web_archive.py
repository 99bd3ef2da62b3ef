"""WARC in ZIP: round trips, foreign and ZIP64 packages, damage."""

import base64
import gzip
import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from tidemark.llm import web_archive as web

PAGES = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def plain(rows, revisit_from=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        html = html or ""
        other = first.get(html) if len(html.encode()) >= revisit_from else None
        again = other is not None and other != i
        out.append((i, len(html.encode()), digest(html), "revisit" if again else "response", other if again else None))
    return sorted(out, key=repr)


def back(frame):
    return sorted(map(tuple, frame.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


ROWS = ([(i, f"https://a.org/{i}", f"<p>{i % 7} für\r\n\r\nWARC/1.1 {'x' * (i * 50)}</p>" if i % 3 else "same") for i in range(60)]
        + [(100, None, None), (101, "", ""), (102, "http://x/ \r\nWARC-Type: y\tü", "a"), (None, "u", "same"), (None, None, "alone"),
           (3, "https://a.org/3", "same"), (7, "again", "same"), (103, "long", "ü" * 3_000_000), (-5, "below", "a")])


@pytest.mark.parametrize("revisit_from", [0, 5])
def test_round_trip(spark, folder, revisit_from):
    pages = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "'x' AS digest", "1 AS first", "2 AS payload", "3 AS path", "4 AS refers_to")
    manifest = web.write(pages.repartition(3), folder, revisit_from=revisit_from, package_records=15)
    assert manifest.count() >= 4 and manifest.agg({"records": "sum"}).first()[0] == len(ROWS)
    got = web.read(manifest.unionAll(manifest), with_payload=True, range_bytes=4000)
    assert back(got) == plain(ROWS, revisit_from)
    responses = got.where("record_type = 'response'").collect()
    assert all(r.intact and digest(bytes(r.payload).decode()) == r.payload_digest for r in responses)
    assert web.ranges(manifest, range_bytes=4000).count() > manifest.count()


def test_no_pages_and_no_packages(spark, folder):
    none = web.write(spark.createDataFrame([], PAGES), folder)
    assert none.agg({"records": "sum"}).first()[0] is None and web.read(none).collect() == []


def test_packages_open_with_other_tools(spark, folder):
    manifest = web.write(spark.createDataFrame(ROWS[:9], PAGES).coalesce(1), folder)
    with zipfile.ZipFile(manifest.first().path.replace("file:", "")) as z:
        assert z.testzip() is None and z.namelist() == [web.WARC_MEMBER, web.INDEX_MEMBER]
        assert gzip.decompress(z.read(web.WARC_MEMBER)).count(b"WARC-Type: ") == 9


def package(*, wide=False, method=zipfile.ZIP_STORED, comment=b"", before=b"", index=True, member="archive/data.warc.gz", monkeypatch=None):
    """A package made by another writer, with ZIP64 fields wherever they can stand."""
    out = io.BytesIO()
    rows = [web.record_bytes(i, "u", b"x" * 300, web.digest_of(b"x" * 300), None, "2020-01-01T00:00:00Z") for i in range(3)]
    packed = [gzip.compress(r) if member.endswith(".gz") else r for r in rows]
    with monkeypatch.context() as m:
        if wide:
            m.setattr(zipfile, "ZIP64_LIMIT", 5)
            m.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
        with zipfile.ZipFile(out, "w", method) as z:
            z.writestr("datapackage.json", "{}" * 50)
            z.writestr(member, b"".join(packed))
            if index:
                at, lines = 0, []
                for p in packed:
                    lines.append(f'u 2020 {{"offset": "{at}", "length": {len(p)}, "filename": "data.warc{".gz" if member.endswith(".gz") else ""}"}}\n')
                    at += len(p)
                z.writestr("indexes/index.cdx", "".join(reversed(lines)))
            z.comment = comment
    return before + out.getvalue()


@pytest.mark.parametrize("change", [
    {}, {"wide": True}, {"comment": b"a PK\5\6 in a comment" + b"!" * 40}, {"before": b"#!/bin/sh\n" * 9}, {"index": False},
    {"wide": True, "before": b"junk", "comment": b"c"}, {"member": "archive/data.warc"}, {"member": "archive/data.warc", "index": False}])
def test_foreign_packages(spark, folder, monkeypatch, change):
    data = package(monkeypatch=monkeypatch, **change)
    with open(f"{folder}/p.zip", "wb") as f:
        f.write(data)
    members = web.central_directory(pa.BufferReader(data))
    assert [m.name for m in members] == ["datapackage.json", change.get("member", "archive/data.warc.gz"),
                                         "indexes/index.cdx"][:2 if "index" in change else 3]
    if change.get("wide"):
        assert web.END64 in data
    got = web.read(spark.createDataFrame([(f"file://{folder}/p.zip",), (None,)], "path string"), range_bytes=300).collect()
    assert sorted((r.page_id, r.payload_bytes, r.intact) for r in got) == [(i, 300, True) for i in range(3)]


def test_damage_is_named_and_fails_when_strict(spark, folder, monkeypatch):
    good = package(monkeypatch=monkeypatch)
    at = good.find(b"\x1f\x8b", good.find(b"\x1f\x8b") + 4)
    harm = {"short": good[:-30], "empty": b"", "text": b"no zip" * 40, "gone": None,
            "packed": package(monkeypatch=monkeypatch, method=zipfile.ZIP_DEFLATED),
            "spoilt": good[:at + 12] + b"\0" * 20 + good[at + 32:]}
    for name, data in harm.items():
        if data is not None:
            with open(f"{folder}/{name}", "wb") as f:
                f.write(data)
    with open(f"{folder}/good", "wb") as f:
        f.write(good)
    paths = spark.createDataFrame([(f"{folder}/{n}",) for n in (*harm, "good")], "path string")
    got = web.read(paths, strict=False).collect()
    problems = {r.path.rpartition("/")[2] for r in got if r.problem}
    assert problems == set(harm)
    assert sorted(r.page_id for r in got if r.path.endswith("good")) == [0, 1, 2]
    with pytest.raises(Exception, match="spoilt"):
        web.read(paths.where("path LIKE '%spoilt'")).collect()
