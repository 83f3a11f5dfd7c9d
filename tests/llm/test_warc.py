"""Archives written, normalised and read back."""

import base64
import gzip
import hashlib
import io
import zlib

import pytest

from guardwork.llm import warc
from guardwork.llm.files import reading
from guardwork.llm.oracle import LLM_ORACLE_SQL
from guardwork.llm.queries import LLM_QUERIES
from guardwork.llm.shared import shared_folder

PAGES = "page_id long, url string, html string"


def expected(rows):
    first = {}
    for r in rows:
        if r.page_id is not None:
            payload = r.html or ""
            first[payload] = min(first.get(payload, r.page_id), r.page_id)
    out = []
    for r in rows:
        payload, data = r.html or "", (r.html or "").encode()
        refers = first.get(payload)
        refers = None if refers == r.page_id else refers
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((r.page_id, len(data), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def check(df):
    assert sorted(map(tuple, warc.archive_report(df).collect()), key=str) == expected(df.collect())


def test_awkward_pages(llm):
    rows = [
        (5, "http://a/b", "<p>same</p>"),
        (3, None, "<p>same</p>"),
        (9, "http://a/\r\nInjected: x", "<p>same</p>"),
        (3, "http://a/again", "<p>same</p>"),
        (None, "u", "<p>same</p>"),
        (1, "u", None),
        (2, "u", ""),
        (None, None, "only without ids"),
        (None, "x", "only without ids"),
        (11, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 3),
        (12, "u", "é東😀" * 400_000),
        (-4, "u", "negative"),
    ]
    df = llm.createDataFrame(rows, PAGES)
    check(df.selectExpr("*", "'x' AS digest", "1 AS n", "2 AS refers_to", "3 AS response"))


def test_query_on_all_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    rows = LLM_QUERIES["op9_warc"](spark, small).collect()
    assert sorted(map(tuple, rows), key=str) == expected(pages.collect())
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{small}/pages.parquet')")
    assert sorted(con.execute(LLM_ORACLE_SQL["op9_warc"]).fetchall(), key=str) == sorted(map(tuple, rows), key=str)


def test_empty_table(llm):
    assert warc.archive_report(llm.createDataFrame([], PAGES)).collect() == []


def test_normalised_archives_have_a_member_per_record(llm, monkeypatch):
    monkeypatch.setattr(warc, "_PIECE", 100)
    df = llm.createDataFrame([(i, f"http://x/{i}", "y" * (i * 37)) for i in range(40)], PAGES)
    whole, folder = (shared_folder(llm, n) for n in ("whole", "members"))
    files = warc.write_archives(warc.with_responses(df).coalesce(1), whole)
    names = [r["name"] for r in warc.normalise(files, whole, folder).collect()]
    records = 0
    for name in names:
        with reading(whole, name) as stream:
            monolithic = stream.read()
        with reading(folder, name) as stream:
            normal = stream.read()
        with reading(folder, f"{name}.idx") as stream:
            index = [tuple(map(int, line.split())) for line in stream.read().decode().splitlines()]
        assert gzip.decompress(monolithic) == gzip.decompress(normal)
        inflate = zlib.decompressobj(31)
        inflate.decompress(monolithic)
        assert inflate.eof and not inflate.unused_data  # one member in all
        assert sum(length for _, length in index) == len(normal)
        for offset, length in index:
            record = gzip.decompress(normal[offset : offset + length])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        records += len(index)
    assert records == 40


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_records_are_found_however_the_stream_is_cut(monkeypatch, piece):
    monkeypatch.setattr(warc, "_PIECE", piece)
    records = [warc.record(i, "u", b"\r\n\r\n" * i, None if i % 2 else 0) for i in range(6)]
    for data in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        assert list(warc.records_in(io.BytesIO(data))) == records


def test_a_cut_archive_is_an_error():
    data = warc.member(warc.record(1, "u", b"payload", None)[:-9])
    with pytest.raises(ValueError):
        list(warc.records_in(io.BytesIO(data)))
