import random

import numpy as np
import pytest

from panelforge.llm import decontaminate as D
from tests.llm import cases

BENCH = "item_id long, text string"


def edits(pattern: bytes, text: bytes) -> int:
    """Fewest edits between the pattern and any region of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def brute(docs, items):
    """Whether any segment of an item lies in the document within its edits."""
    out = set()
    index = D.Segments(items)
    for d, t in docs:
        body = D.normalised(t or "")
        for text, item, e in zip(index.texts, index.items, index.edits):
            if (d, item) not in out and edits(text, body) <= e:
                out.add((d, item))
    return out


def found(df, bench):
    return {(r.doc_id, r.item_id) for r in D.contaminated(df, bench).collect()}


def changed(rng, text, n):
    text = list(text)
    for _ in range(n):
        at = rng.randrange(len(text))
        kind = rng.randrange(3)
        text[at : at + (kind != 1)] = [] if kind == 0 else [rng.choice("abcdefgh")]
    return "".join(text)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(6)
    items = [(i, " ".join(cases.words(rng, n))) for i, n in enumerate((8, 12, 20, 40, 60))] + [(90, None), (91, "short"), (None, "no id " * 20)]
    docs = []
    for k in range(40):
        text = items[k % 5][1]
        if k % 4 == 1:
            text = changed(rng, text.upper(), k // 4)
        elif k % 4 == 2:
            text = text[: len(text) // 2].replace(" ", "\n")
        elif k % 4 == 3:
            text = ""
        docs.append((k, " ".join([*cases.words(rng, rng.randint(0, 25)), text, *cases.words(rng, rng.randint(0, 25))]), None, None, 0))
    return docs + [(100, None, None, None, 0), (101, "", None, None, 0), (None, items[2][1], None, None, 0), (0, items[3][1], None, None, 0)], items


@pytest.mark.parametrize("clash", [False, True])
def test_equals_brute_force(spark, planted, clash):
    docs, items = planted
    df, bench = cases.table(spark, docs, clash), spark.createDataFrame(items, BENCH)
    got = found(df, bench)
    assert got == brute([(d, t) for d, t, *_ in docs], [x for x in items if x[0] is not None])
    assert len(got) > 20
    rest = D.drop_contaminated(df, bench)
    assert {r.doc_id for r in rest.collect()} == {d for d, *_ in docs} - {d for d, _ in got if d is not None}


def test_slices_give_the_same(spark, planted, monkeypatch):
    docs, items = planted
    df, bench = cases.table(spark, docs), spark.createDataFrame(items, BENCH)
    whole = found(df, bench)
    monkeypatch.setattr(D, "SLICE_BYTES", 300)
    assert found(df, bench) == whole


def test_items_of_the_benchmark_in_the_documents(spark):
    docs = cases.documents(spark)
    bench = spark.read.parquet(f"{cases.SF}/benchmark.parquet")
    got = found(docs, bench)
    items = [(r.item_id, D.normalised(r.text)) for r in bench.collect()]
    exact = {(d, i) for d, t in cases.pairs_of(docs) for i, x in items if x in D.normalised(t)}
    assert exact and exact <= got


def test_other_cases_do_not_fail(spark):
    bench = spark.createDataFrame([(1, "x" * 300), (2, "two words that no document has but this one, of fifty bytes")], BENCH)
    assert found(cases.table(spark), bench) == {(23, 1)}
    assert found(cases.table(spark, []), bench) == set()
    assert found(cases.table(spark), spark.createDataFrame([], BENCH)) == set()


def test_banded_edits_agree_with_the_full_table():
    rng = random.Random(3)
    for _ in range(30):
        pattern = "".join(rng.choice("abc") for _ in range(40))
        region = "".join(rng.choice("abc") for _ in range(8)) + changed(rng, pattern, rng.randint(0, 4)) + "abc" * 20
        region = region[:70].encode()
        got = int(D.banded_edits(np.frombuffer(pattern.encode(), np.uint8), np.frombuffer(region, np.uint8)[None, :])[0][0])
        best = edits(pattern.encode(), region)
        assert got >= best and (best > 4 or got == best)


def test_passages_at_all_offsets():
    # independent of the segments: each document holds a planted passage of an item, or words of its own
    rng = random.Random(12)
    items = [(k, " ".join(cases.words(rng, n))) for k, n in enumerate((22, 45, 70))]
    bodies = {k: D.normalised(t).decode() for k, t in items}
    bodies[0] = bodies[0][:144].strip()
    items[0] = (0, bodies[0])
    docs, expected = [], set()
    for k, body in bodies.items():
        for at in range(len(body) - 62):
            for passage in (body[at : at + 63], changed(rng, body[at : at + 63], 2)):
                expected.add((len(docs), k))
                docs.append(" ".join(cases.words(rng, 12)) + passage + " ".join(cases.words(rng, 12)))
    docs += [" ".join(cases.words(rng, 60)) for _ in range(100)]
    index = D.Segments(items)
    assert {(d, index.items[s]) for d, s, *_ in D.matches(index, [D.normalised(t) for t in docs])} == expected


def test_short_items_are_matched_word_for_word(spark):
    bench = spark.createDataFrame([(1, "Who wrote  it?"), (2, "seventeen"), (3, " "), (4, "häß lich")], BENCH)
    texts = ["a who\nWROTE it? b", "who wrote it", "seventeen", "seventeenth", "x HÄSS lich häß lich", "", None, "who who wrote it? seventeen seventeen"]
    df = cases.table(spark, [(k, t, None, None, 0) for k, t in enumerate(texts)])
    assert found(df, bench) == {(0, 1), (2, 2), (4, 4), (7, 1), (7, 2)}
    spans = {(r.doc_id, r.item_id): [tuple(s) for s in r.spans] for r in D.contaminated(df, bench).collect()}
    assert spans[7, 1] == [(4, 17)] and spans[7, 2] == [(18, 27)]
