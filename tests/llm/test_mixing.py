import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelforge.llm import mixing as M
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(3, 1, 2), budget=1.5, most=2.0):
    """Water filling, step by step."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    open_, left, out = [s for s in order if sizes[s]], budget * sum(sizes.values()), dict.fromkeys(order, 0.0)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if most * sizes[s] <= level * weight[s]]
        if not full:
            out |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ = [s for s in open_ if s not in full]
    return out


def check(df):
    rows = M.mix(df).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.mix_size == len(WORD.findall(r.text or ""))
        assert 0 <= r.mix_taken <= 2 * r.mix_size
        assert all(0 <= x["from"] < x["to"] <= r.mix_size for x in r.mix_ranges)
        sizes[r.source] += r.mix_size
        taken[r.source] += r.mix_taken
    wanted = targets(sizes)
    for r in rows:
        assert r.mix_source_size == sizes[r.source]
        assert r.mix_target == pytest.approx(wanted[r.source])
    for s, n in taken.items():
        assert abs(n - wanted[s]) <= 0.02 * wanted[s] + 20, (s, n, wanted[s])
    return rows


def test_documents(spark):
    df = cases.documents(spark)
    rows = check(df)
    again = M.mix(df.repartition(5)).collect()
    assert sorted((r.doc_id, r.mix_taken) for r in rows) == sorted((r.doc_id, r.mix_taken) for r in again)


@pytest.mark.parametrize("clash", [False, True])
def test_cases(spark, clash):
    df = cases.table(spark, clash=clash)
    got = M.mix(df)
    assert got.columns == [*[c for c in df.columns if c not in M.ADDED], *M.ADDED]
    assert len(check(df)) == len(cases.rows())


def test_quotas_are_the_highest_quotients(spark):
    shares = [0.2, 3.7, 10.4, 55.5, 0.6, 7.1, 21.5, 100.0]
    streams = spark.createDataFrame([(f"s{i}", 0, 1000, x) for i, x in enumerate(shares)], "skey string, part int, blocks long, share double")
    got = {r.skey: r.quota for r in M._quotas(streams, 2.0).collect()}
    quotients = sorted(((-x / (2 * k + 1), f"s{i}") for i, x in enumerate(shares) for k in range(200)))[: int(sum(shares) + 0.5)]
    assert got == {f"s{i}": sum(s == f"s{i}" for _, s in quotients) for i in range(len(shares))}


@pytest.mark.parametrize("most, budget", [(1.5, 1.3), (3.0, 2.5)])
def test_other_bounds_than_two(spark, most, budget):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randrange(20, 300)), "small" if i % 20 == 0 else "large") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.mix(df, weights=(1, 3), budget=budget, most=most).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.mix_size
        taken[r.source] += r.mix_taken
        assert r.mix_taken <= math.ceil(most) * r.mix_size
    wanted = targets(sizes, (1, 3), budget, most)
    assert wanted["small"] == most * sizes["small"]  # stopped at the bound
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= 0.001 * wanted[s] + M.BLOCK_WORDS, (s, taken[s], wanted[s])


def test_mixed_documents_hold_the_words_taken(spark):
    df = cases.documents(spark)
    mixed = M.mix(df)
    out = M.mixed_documents(mixed)
    assert out.columns == df.columns
    words = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(M.WORD))).alias("n")).collect()}
    assert words == {r.doc_id: r.mix_taken for r in mixed.collect() if r.mix_taken}
    assert out.where(F.col("n_chars") != F.length("text")).count() == 0


def test_empty_table(spark):
    assert M.mix(cases.table(spark, [])).collect() == []
    assert M.mix(cases.table(spark, [(1, None, None, None, None), (2, "", None, "a", 0)])).count() == 2


@pytest.mark.parametrize("copies", [1, 10])
def test_documents_are_taken_whole_at_every_size(spark, copies):
    df = cases.documents(spark).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).withColumn("doc_id", F.col("doc_id") * 100 + F.col("copy")).drop("copy")
    texts = {r.doc_id: r.text for r in df.collect()}
    sizes = defaultdict(int)
    for r in df.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    cut = [r for r in M.mixed_documents(M.mix(df)).collect() if r.text != texts[r.doc_id]]
    assert all(texts[r.doc_id].startswith(r.text) for r in cut)
    assert len(cut) <= sum(n // M.STREAM_WORDS + 1 for n in sizes.values())
    wanted = targets(sizes)
    assert any(wanted[s] < sizes[s] for s in sizes)


def test_partial_takes_keep_their_line_breaks(spark):
    rows = [(1, "a", " one two\n\nthree\tfour \n", 1, [(0, 3)]), (2, "a", "one two\n three four\n", 0, [(1, 3)]), (3, "a", "x y", 0, [])]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, mix_passes int, mix_ranges array<struct<from:long,to:long>>")
    mixed = df.withColumns({"mix_size": F.lit(4), "mix_taken": F.lit(3)})
    got = sorted((r.doc_id, r.text) for r in M.mixed_documents(mixed).collect())
    assert got == [(1, " one two\n\nthree"), (1, " one two\n\nthree\tfour \n"), (2, "two\n three")]
