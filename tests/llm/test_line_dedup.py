import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from panelforge.llm import line_dedup as L
from tests.llm import cases


def brute(docs, least_chars=40, least_docs=5):
    holders = defaultdict(set)
    for d, t in docs:
        for x in (t or "").split("\n"):
            holders[L.line_key(x)].add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(L.line_key(x)) >= least_chars and len(holders[L.line_key(x)]) >= least_docs and max(holders[L.line_key(x)], key=lambda i: -1 if i is None else i) != d)]
        out.append((str(d), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def found(df, **least):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_text) for r in L.keep_lines(df, L.keep_bitmaps(df, **least)).collect())


def test_equals_brute_force_on_the_documents(spark):
    df = cases.documents(spark)
    assert found(df) == brute(cases.pairs_of(df))


@pytest.mark.parametrize("clash", [False, True])
def test_cases(spark, clash):
    df = cases.table(spark, clash=clash)
    assert found(df) == brute(cases.pairs_of(df))


def test_a_line_of_very_many_documents(spark):
    line = "the same long line in very many of the documents here"
    df = cases.table(spark, [(i, f"{line}\n{line.upper()}\nown {i}", None, None, None) for i in range(3000)])
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:  # many batches: the run crosses their edges
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
        got = found(df)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert got == brute(cases.pairs_of(df))
    assert sum(x[2] for x in got) == 2 * 2999


def streamed(parts, least, size):
    """Marked rows of partitions of (hi, lo, doc) in order, read in batches of ``size`` rows."""
    out = []
    for rows in parts:
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())]
        batches = []
        for at in range(0, len(rows), size):
            hi, lo, doc = zip(*rows[at : at + size])
            n = len(hi)
            batches.append(pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((hi, lo, doc, [0] * n, [[1]] * n), kinds)], ["hi", "lo", "doc_id", "text_key", "lines"]))
        out.append([r for b in L._streamed(least)(iter(batches)) for r in b.to_pylist()])
    return out


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_runs_go_on_across_batches_and_partitions(size):
    rng = np.random.default_rng(size)
    rows = sorted({(int(h), int(h) % 3, int(d)) for h, d in zip(rng.integers(0, 12, 300) // 2, rng.integers(0, 60, 300))}, key=lambda r: (r[0], r[1], -r[2]))
    rows = [r for r in rows for _ in range(1 + r[2] % 2)]  # repeated rows
    cuts = [0, *[i for i in range(1, len(rows)) if i % 41 == 0 and rows[i] != rows[i - 1]], len(rows)]
    parts = streamed([rows[a:b] for a, b in zip(cuts, cuts[1:])], 5, size)
    marked = [r for p in parts for r in p]
    pieces = defaultdict(list)
    for r in marked:
        if r["kind"] == L._PIECE:
            pieces[r["hi"], r["lo"]].append((r["documents"], r["doc_id"]))
    got = sorted((r["hi"], r["lo"], r["doc_id"]) for r in marked if r["kind"] == L._DROPPED)
    for r in marked:
        of = pieces[r["hi"], r["lo"]] if r["kind"] == L._OPEN else []
        if of and sum(n for n, _ in of) >= 5 and max(d for _, d in of) != r["doc_id"]:
            got.append((r["hi"], r["lo"], r["doc_id"]))
    holders = defaultdict(set)
    for h, l, d in rows:
        holders[h, l].add(d)
    assert sorted(got) == sorted(r for r in rows if len(holders[r[:2]]) >= 5 and r[2] != max(holders[r[:2]]))


def test_a_common_line_leaves_few_open_rows():
    rows = [(7, 7, d) for d in range(50_000, 0, -1)]
    parts = streamed([rows[a : a + 10_000] for a in range(0, 50_000, 10_000)], 5, 1000)
    for p in parts:
        assert [r["kind"] for r in p if r["kind"] != L._DROPPED] == [L._OPEN, L._PIECE]
        assert sum(r["kind"] == L._DROPPED for r in p) == 9_999


def test_one_document_with_very_many_rows_is_not_held(monkeypatch):
    monkeypatch.setattr(L, "_HELD_ROWS", 50)
    rows = [(7, 7, 9)] * 500 + [(7, 7, d) for d in (8, 6, 5, 4)]
    (marked,) = streamed([[(1, 1, 1), *rows, (8, 8, 1)]], 5, 20)
    mine = [r for r in marked if r["hi"] == 7]
    assert [(r["doc_id"], r["documents"]) for r in mine if r["kind"] == L._PIECE] == [(9, 5)]
    assert sum(r["kind"] == L._DROPPED for r in mine) + sum(r["kind"] == L._OPEN and r["doc_id"] != 9 for r in mine) == 4


def test_empty_table(spark):
    assert found(cases.table(spark, [])) == []


def test_bitmap(spark):
    df = cases.table(spark)
    for r in L.keep_bitmaps(df).collect():
        bits = np.unpackbits(np.frombuffer(zlib.decompress(r.keep_bitmap), np.uint8), bitorder="little")
        assert (bits == 0).sum() == r.n_dropped > 0
