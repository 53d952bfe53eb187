import re
from collections import Counter

import pytest

from panelforge.llm import quality as Q
from tests.llm import cases


def brute(docs):
    out = []
    for d, t in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        inside = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
        doc = Q.Doc(t, len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside))
        kept = not failed and not any(rule(doc) for rule in Q.RULES.values())
        out.append((str(d), doc.n_words, doc.word_chars, doc.n_symbols, doc.n_dup_lines, doc.n_repeat_words, failed, kept))
    return sorted(out)


def found(df, order=None):
    return sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in Q.quality(df, order).collect())


def test_equals_brute_force_on_the_documents(spark):
    df = cases.documents(spark)
    assert found(df) == brute(cases.pairs_of(df))


@pytest.mark.parametrize("clash", [False, True])
def test_cases(spark, clash):
    df = cases.table(spark, clash=clash)
    assert found(df) == brute(cases.pairs_of(df))


def test_the_order_changes_the_work_but_not_the_verdict(spark):
    df = cases.documents(spark)
    order = Q.estimate_order(df)
    assert sorted(order) == sorted(Q.RULES)
    assert found(df, order) == found(df, order[::-1])

    def tried(o):
        return sum(r.rules_run for r in Q.quality(df, o).collect())

    assert tried(order) <= tried(order[::-1])


def test_most_clean_documents_stay(spark):
    labels = spark.read.parquet(f"{cases.SF}/labels.parquet").where("quality = 1")
    rows = Q.quality(cases.documents(spark)).join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r.kept for r in rows) == len(rows)


def test_empty_table(spark):
    assert found(cases.table(spark, [])) == []
