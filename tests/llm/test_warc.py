import base64
import gzip
import hashlib
import io
import os

import pytest

from panelforge.llm import warc as W
from tests.llm import cases

PAGES = [
    (5, "http://a.example/1", "<html>one</html>"),
    (3, "http://a.example/2", "<html>one</html>"),
    (9, "http://a.example/3", "<html>one</html>"),
    (4, None, None),
    (7, "http://a.example/\r\n\"x\" ü", ""),
    (8, "http://a.example/5", "WARC/1.1\r\n\r\n\r\n\r\nContent-Length: 5\r\n\r\n"),
    (None, "http://a.example/6", "<html>one</html>"),
    (10, "http://a.example/7", "ü\U0001f600" * 200_000),
    (11, "http://a.example/8", "twice"),
    (11, "http://a.example/8", "twice"),
]


def brute(pages, least=0):
    first = {}
    for p, _, h in pages:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    out = []
    for p, u, h in pages:
        body = (h or "").encode()
        refers = first.get(h or "") if len(body) >= least and p is not None else p
        refers = None if refers == p else refers
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((str(p), u or "", len(body), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def found(df, **k):
    return sorted(((str(r.page_id), r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in W.round_trip(df, **k).collect()), key=str)


def pages(spark, data=PAGES):
    return spark.createDataFrame(data, "page_id long, url string, html string").repartition(2)


@pytest.mark.parametrize("least", [0, 10])
def test_cases(spark, least):
    assert found(pages(spark), least_bytes=least) == brute(PAGES, least)


def test_equals_brute_force_on_the_pages(spark):
    df = spark.read.parquet(f"{cases.SF}/pages.parquet")
    assert found(df) == brute([(r.page_id, r.url, r.html) for r in df.collect()])


def test_payloads_come_back(spark):
    got = {(r.page_id, r.url): bytes(r.payload).decode() for r in W.round_trip(pages(spark)).where("record_type = 'response'").collect()}
    for p, u, h in PAGES:
        if (p, u or "") in got:
            assert got[p, u or ""] == (h or "")
    assert len(got) == 6  # ids 3, 4, 8, 10, 11 and the page without id


def test_extra_columns_and_empty_table(spark):
    from pyspark.sql import functions as F

    clash = pages(spark).withColumns({"digest": F.lit("x"), "first": F.lit(1), "size": F.lit(2), "refers_to": F.lit(3)})
    assert found(clash) == brute(PAGES)
    assert found(pages(spark, [])) == []


def test_members_and_index(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    manifest = W.write_archives(pages(spark), folder)
    for row in W.normalise(manifest).collect():
        raw = open(row.archive.removeprefix("file://"), "rb").read()
        entries = [x.split("\t") for x in open(row['index'].removeprefix("file://")).read().splitlines()]
        assert len(entries) == row.records
        assert sum(int(n) for _, _, n in entries) == len(raw) == os.path.getsize(row.archive.removeprefix("file://"))
        for record_id, at, n in entries:  # every member stands alone
            whole = gzip.decompress(raw[int(at) : int(at) + int(n)])
            assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n") and record_id.encode() in whole
        mono = row.archive.removeprefix("file://").split(".")[0] + ".warc.gz"
        assert gzip.open(mono).read() == gzip.decompress(raw)


def test_broken_archives_are_refused():
    record = W.record(1, "u", b"abc", "D", 3, None)
    assert len(list(W.split_records(iter([record[:7], record[7:], record])))) == 2
    with pytest.raises(ValueError):
        list(W.split_records(iter([record[:-20]])))
    with pytest.raises(ValueError):
        list(W.split_records(iter([b"no record\r\n\r\n"])))


def test_inflates_one_or_several_members():
    data = os.urandom(1 << 20)
    both = gzip.compress(data) + gzip.compress(b"more")
    assert b"".join(W.inflated(io.BytesIO(both))) == data + b"more"
