import hashlib
import json
import zipfile

import duckdb
import pytest
from pyarrow import fs

import helpers
from conftest import SF_SMALL
from respawn.llm import warc_zip as op

PAGES = "page_id long, url string, html string"


def expected(rows):
    raw = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in raw:
        if len(b) >= op.REVISIT_BYTES and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, b in raw:
        again = len(b) >= op.REVISIT_BYTES and b in first and first[b] != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


def test_round_trip_and_sql(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = sorted(map(tuple, op.archive_round_trip(pages).collect()), key=str)
    assert got == expected([(r.page_id, r.url, r.html) for r in pages.collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF_SMALL}/pages.parquet')")
    assert sorted(con.execute(op.ORACLE_SQL).fetchall(), key=str) == got


def test_odd_rows(spark):
    body = "<p>é" + "x" * 200
    rows = [(1, "http://a/ b\r\nX: y", body), (2, None, body), (3, "http://c", None), (4, "http://d", ""), (5, "", "short"), (6, "u", "short"),
            (None, "n", body), (0, "z", body), (0, "z", body), (7, "l", "y" * 300000), (8, "m", "\r\n\r\nWARC/1.1\r\n" * 20), (None, None, None)]
    df = helpers.clashing(spark.createDataFrame(rows, PAGES))
    assert sorted(map(tuple, op.archive_round_trip(df).collect()), key=str) == expected(rows)
    assert op.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0
    no_ids = [(None, "a", body), (None, "b", body)]
    assert sorted(map(tuple, op.archive_round_trip(spark.createDataFrame(no_ids, PAGES)).collect()), key=str) == expected(no_ids)


def test_payloads_come_back(spark, tmp):
    rows = [(i, f"http://h/{i}", f"<html>{i}" + "z" * i) for i in range(50)]
    manifest = op.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), f"{tmp}/packages")
    assert sum(r.records for r in manifest.collect()) == 50
    got = {r.record_id: (r.url, bytes(r.payload).decode()) for r in op.read_archives(manifest).collect()}
    assert got == {op.record_id(i): (u, h) for i, u, h in rows}


def package(path, members, method=zipfile.ZIP_STORED, comment=b""):
    with zipfile.ZipFile(path, "w", method) as z:
        for name, raw in members:
            z.writestr(name, raw)
        z.comment = comment


def records(n):
    import gzip
    raw = [gzip.compress(op.warc_record(i, f"u{i}", b"p" * i, hashlib.sha256(b"p" * i).hexdigest(), "response", None)) for i in range(n)]
    at, lines = 0, []
    for i, r in enumerate(raw):
        lines.append(f"u{i} 2024 " + json.dumps({"filename": op.WARC_MEMBER, "offset": str(at), "length": str(len(r))}))
        at += len(r)
    return raw, "\n".join(lines) + "\n"


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("indexed", [False, True])
def test_directories(tmp_path, monkeypatch, zip64, indexed):
    """ZIP64 directories (forced by a tiny limit), comments that look like an end record, no index."""
    if zip64:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw, index = records(30)
    path = str(tmp_path / "x.wacz")
    members = [("other.txt", b"PK\5\6 not an end"), (op.WARC_MEMBER, b"".join(raw))] + [(op.INDEX_MEMBER, index)] * indexed
    package(path, members, comment=b"PK\5\6" + bytes(18))
    data = open(path, "rb").read()
    assert (b"PK\6\6" in data) == zip64
    found = list(op.locate_records(path))
    assert [data[a:a + n] for a, n in found] == raw
    with fs.LocalFileSystem().open_input_file(path) as f:
        assert {m.name: m.size for m in op.read_directory(f, f.size())} == {name: len(raw) for name, raw in members}


def test_refuses_what_it_cannot_read(tmp_path):
    path = str(tmp_path / "c.wacz")
    package(path, [(op.WARC_MEMBER, b"x" * 100)], zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError, match="compressed"):
        list(op.locate_records(path))
    (tmp_path / "no.zip").write_bytes(b"nothing")
    with pytest.raises(ValueError, match="end of central directory"):
        list(op.locate_records(str(tmp_path / "no.zip")))
