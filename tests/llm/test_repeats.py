import random

import pytest

from panelforge.llm import repeats as R
from tests.llm import cases


def brute(docs):
    first = {}
    texts = [(-1 if d is None else d, (t or "").encode(), d) for d, t in docs]
    for d, b, _ in sorted(set(texts), key=lambda x: x[0]):
        for i in range(len(b) - R.LENGTH + 1):
            first.setdefault(b[i : i + R.LENGTH], (d, i))
    out = []
    for d, b, own in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - R.LENGTH + 1):
            if first[b[i : i + R.LENGTH]] != (d, i):
                gone[i : i + R.LENGTH] = b"\1" * R.LENGTH
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out.append((str(own), len(b), sum(gone), runs, bytes(x for x, y in zip(b, gone) if not y)))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in R.remove_repeats(df).collect())


@pytest.fixture
def small_batches(spark):
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def unique_ids(data):
    """Rows under one id but with two texts are left out: their spans fall on both texts."""
    return [r for r in data if r[0] != 26]


def test_equals_brute_force_on_the_documents(spark):
    df = cases.documents(spark)
    assert found(df) == brute(cases.pairs_of(df))


@pytest.mark.parametrize("clash", [False, True])
def test_cases(spark, clash):
    df = cases.table(spark, unique_ids(cases.rows()), clash)
    assert found(df) == brute(cases.pairs_of(df))


def test_runs_that_cross_batches(spark, small_batches):
    rng = random.Random(8)
    passage = " ".join(cases.words(rng, 40))
    data = [(i, " ".join(cases.words(rng, 15)) + passage[i % 7 : 150 + i % 40] + " ".join(cases.words(rng, 15)), None, None, None) for i in range(200)]
    data += [(300 + i, data[0][1], None, None, None) for i in range(150)]
    df = cases.table(spark, data)
    assert found(df) == brute(cases.pairs_of(df))


def test_repeats_inside_one_document(spark):
    rng = random.Random(4)
    a = " ".join(cases.words(rng, 60))
    df = cases.table(spark, [(1, a + a + "zz" + a[:150], None, None, None), (2, "ab" * 400, None, None, None), (3, "ba" * 60, None, None, None)])
    assert found(df) == brute(cases.pairs_of(df))


def test_long_documents_are_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(R, "PIECE", 1000)
    rng = random.Random(2)
    a = " ".join(cases.words(rng, 1500))
    buf_rows = [(1, a, None, None, None), (2, a[500:3000] + " x " + a[:2000], None, None, None)]
    import pyarrow as pa

    whole = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([x[1] for x in buf_rows])], ["doc_id", "text"])
    pieces = pa.concat_tables([pa.Table.from_batches([b]) for b in R._suffixes(iter([whole]))]).to_pylist()
    monkeypatch.setattr(R, "PIECE", 1 << 22)
    at_once = pa.concat_tables([pa.Table.from_batches([b]) for b in R._suffixes(iter([whole]))]).to_pylist()

    def strings(rows):
        return sorted((r["doc_id"], s, r["token"]) for r in rows for s in range(r["strings"] >> 16, (r["strings"] >> 16) + (r["strings"] & 255) + 1))

    assert strings(pieces) == strings(at_once)


def test_rows_of_one_id_with_two_texts_do_not_fail(spark):
    got = found(cases.table(spark))
    assert len(got) == len(cases.rows())


def test_empty_table(spark):
    assert found(cases.table(spark, [])) == []
