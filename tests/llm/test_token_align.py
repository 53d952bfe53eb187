"""Alignment of two tokenizers against a brute force over tokens, and its edge cases."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelforge.llm import token_align as T
from tests.llm import cases

ODD = ["▁x under", "<s>hi</s> <|endoftext|>", "<0x41> \x00", "é ﬁ Ａ", "\U0001f600" * 3, "a\xa0b\r\n\tc", " ", "x" * 3000, "a" + " \t\n" * 4000 + "b"]


def brute(texts):
    """Per text: (n_a, n_b, n_groups, n_links, n_best, count_sum, digest), by nested loops over tokens."""
    with open(T.BPE_FILE, encoding="utf-8") as f, open(T.PIECE_FILE, "rb") as g:
        models = T.Tokenizers(f.read(), g.read())
    done, held = [], Counter()
    for text in texts:
        want = b" " + (text or "").encode()
        a = models.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = models.b.encode(text) if text else []
        if b"".join(models.a_bytes[i] for i in a) != want or b"".join(models.b_bytes[i] for i in b) != want:
            a, b = [], []
        spans = []
        for ids, table in ((a, models.a_bytes), (b, models.b_bytes)):
            at, found = 0, []
            for i in ids:
                found.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(found)
        links = [(i, j) for s, e, i in spans[0] for p, q, j in spans[1] if max(s, p) < min(e, q)] if len(a) < 2000 else None
        if links is None:  # long texts: a merge of the two lists
            links, y = [], 0
            for s, e, i in spans[0]:
                while spans[1][y][1] <= s:
                    y += 1
                z = y
                while z < len(spans[1]) and spans[1][z][0] < e:
                    links.append((i, spans[1][z][2]))
                    z += 1
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, last, x, y = [], 0, 0, 0
        for cut in cuts:
            sides = []
            for side, k in ((spans[0], x), (spans[1], y)):
                ids = []
                while k < len(side) and side[k][1] <= cut:
                    ids.append(str(side[k][2]))
                    k += 1
                sides.append((ids, k))
            x, y = sides[0][1], sides[1][1]
            groups.append("|".join(",".join(ids) for ids, _ in sides))
        done.append((len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        held.update(set(links))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(n, most.get(i, 0))
    return [(na, nb, ng, len(ls), sum(held[p] == most[p[0]] for p in ls), sum(held[p] for p in ls), d) for na, nb, ng, ls, d in done]


def found(df):
    cols = [*T.MEASURES, "align_groups_sha256"]
    return sorted(((r.text or "", *[r[c] for c in cols]) for r in df.select("text", *cols).collect()), key=str)


def expected(texts):
    return sorted(((t or "", *row) for t, row in zip(texts, brute(texts))), key=str)


@pytest.mark.parametrize("chunk", [1 << 24, 3000])
def test_measures_equal_brute_force(spark, chunk):
    data = cases.rows() + [(100 + k, t, "en", "a", 0) for k, t in enumerate(ODD)]
    df = cases.table(spark, data)
    assert found(T.align_tokens(df, chunk_bytes=chunk)) == expected([r[1] for r in data])


def test_ranked_encoder_equals_the_listed_merges():
    with open(T.BPE_FILE, encoding="utf-8") as f, open(T.PIECE_FILE, "rb") as g:
        models = T.Tokenizers(f.read(), g.read())
    assert models.ranked is not None
    points = [chr(c) for c in range(0x3400) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{c}a 1{c}1 !{c}! {c}{c} x  {c}'{c}" for c in points] + [" ".join(cases.words(random.Random(k), 300)) for k in range(20)]
    want = [e.ids for e in models.a.encode_batch(texts, add_special_tokens=False)]
    assert [models.ranked.encode_ordinary(t) for t in texts] == want
    letters = {b: c for c, b in T.byte_alphabet().items()}
    for token, at in list(T.merge_ranks(open(T.BPE_FILE, encoding="utf-8").read()).items())[::37]:
        assert [t.id for t in models.a.model.tokenize("".join(letters[b] for b in token))] == [at]


def test_whole_documents(spark):
    docs = cases.documents(spark)
    texts = [t for _, t in cases.pairs_of(docs)]
    assert found(T.align_tokens(docs)) == expected(texts)


def test_clashing_names_and_empty_table(spark):
    names = ["chunk", "pair", "picks", "times", "copies", "align_n_a", "n_a", "place", "best", "a"]
    df = cases.table(spark, clash=True).select("*", *[F.lit("own").alias(n) for n in names])
    got = T.align_tokens(df)
    assert found(got) == expected([r[1] for r in cases.rows()])
    assert got.where("pair = 'own' AND n_a = 'own' AND band = 'own band'").count() == len(cases.rows())
    assert T.align_tokens(cases.table(spark, []), chunk_bytes=10).collect() == []
    assert found(T.align_tokens(cases.table(spark, [(1, None, "en", "a", 0), (2, "", "en", "a", 0)]))) == [("", 0, 0, 0, 0, 0, 0, "")] * 2


def test_query_gives_each_document_once(spark):
    from panelforge.llm.queries import QUERIES

    got = QUERIES["op11_token_align"](spark, cases.SF)
    assert got.dtypes == [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups_sha256", "string")]
    assert got.count() == cases.documents(spark).count()
