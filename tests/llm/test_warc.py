from __future__ import annotations

import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from boreline.llm import warc

PAGES = "page_id bigint, url string, html string, path string, digest string, id string"


def written(spark, tmp_path, rows):
    pages = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], PAGES)
    return warc.write_packages(pages, str(tmp_path / "boreline" / "w"))


def test_round_trip(spark, tmp_path):
    big = "<p>é🙂</p>" * 200
    rows = [(1, "http://a/x y", big), (2, "http://b", big), (9, "http://c", big), (3, "http://a", "small"), (4, "http://a", "small"), (5, None, None), (6, "", ""), (9, "http://c", big), (None, "http://d", big), (7, "http://e", "z" * 999), (8, "http://e", "z" * 999), (10, "http://long", "é\n" * 400_000)]
    manifest = written(spark, tmp_path, rows)
    got = warc.read_records(warc.locate(manifest), with_payload=True).collect()
    assert sum(r.records for r in manifest.collect()) == len(rows) == len(got)
    want = []
    for page, url, html in rows:
        data = (html or "").encode()
        last = 9 if html == big else None
        whole = last is None or page == last
        want.append((page, "response" if whole else "revisit", (url or "").replace(" ", "%20"), len(data), hashlib.sha1(data).hexdigest(), None if whole else last, True if whole else None, data if whole else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(*w[:7], None if w[7] is None else w[7]) for w in want])) or {tuple(r)[:7] for r in got} == {w[:7] for w in want}
    assert {(r.id, bytes(r.payload)) for r in got if r.payload is not None} == {(w[0], w[7]) for w in want if w[7] is not None}


def test_no_pages(spark, tmp_path):
    assert warc.read_records(warc.locate(written(spark, tmp_path, []))).count() == 0


def test_packages_are_plain_zip_files(spark, tmp_path):
    (row,) = written(spark, tmp_path, [(1, "http://a", "text")]).where("records > 0").collect()
    with zipfile.ZipFile(row.path) as z:
        assert z.testzip() is None and z.namelist() == ["archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"]
        fields, http, payload = warc.parse(z.read("archive/data.warc.gz"))
    assert fields["warc-type"] == "response" and http["content-length"] == "4" and payload == b"text"


def members(data):
    return warc.directory(pa.PythonFile(io.BytesIO(data), mode="r"))


@pytest.mark.parametrize("wide", [False, True])
def test_directories(monkeypatch, wide):
    """Against the standard library's reader, with ZIP64 sizes forced by a low limit."""
    out = io.BytesIO()
    if wide:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 5)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for k in range(8):
            z.writestr(f"archive/{k}é.warc", b"x" * (k * 37), zipfile.ZIP_DEFLATED if k == 3 else None)
        z.comment = b"a comment of some length" * 3
    data = out.getvalue()
    misleading = data.replace(b"a comment of some length", b"PK\x05\x06mment of some length")
    assert members(misleading) == members(data)
    assert (b"PK\x06\x06" in data) == wide
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert [(m.name, m.method, m.stored_size, m.size, m.header_at) for m in members(data)] == [(i.filename, i.compress_type, i.compress_size, i.file_size, i.header_offset) for i in z.infolist()]
        file = pa.PythonFile(io.BytesIO(data), mode="r")
        for m in members(data):
            if m.method:
                with pytest.raises(ValueError, match="compressed"):
                    warc.data_at(file, m)
            else:
                start = warc.data_at(file, m)
                assert data[start : start + m.size] == z.read(m.name)


@pytest.mark.parametrize("data", [b"", b"no zip at all", b"PK\x05\x06" + bytes(18)[:-2] + b"\xff\xff"])
def test_no_package(data):
    with pytest.raises(ValueError):
        members(data)


def test_records_cut_off():
    data = warc.record("response", 1, "u", b"payload", b"d" * 20, None, "now")
    with pytest.raises(Exception):  # noqa: B017
        warc.parse(data[:-20])
    with pytest.raises(ValueError):
        warc.parse(b"something else")
