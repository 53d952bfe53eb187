import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.llm import near_dedup as N
from panelforge.llm.common import mix64
from panelforge.llm.components import connected_components
from tests.llm import cases

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    sets = defaultdict(list)
    for d, t in docs:
        sets[d].append(shingles(t))
    parent = {d: d for d in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(parent, 2):
        if any(x and y and 100 * len(x & y) >= 85 * len(x | y) for x in sets[a] for y in sets[b]):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return sorted((d if d is not None else -1, len(shingles(t)), find(d) if d is not None else None) for d, t in docs)


def found(df):
    got = N.near_duplicates(df).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id) for r in got)


def test_equals_brute_force_on_the_documents(spark):
    docs = cases.documents(spark)
    assert found(docs) == brute(cases.pairs_of(docs))


@pytest.mark.parametrize("clash", [False, True])
def test_cases(spark, clash):
    df = cases.table(spark, clash=clash)
    assert found(df) == brute(cases.pairs_of(df))


def test_chain_that_misses_the_hub(spark):
    # each step changes 11 of 200 words in another place: only neighbours are alike
    rng = np.random.default_rng(3)
    w = [f"w{i}" for i in range(200)]
    docs = []
    for k in range(5):
        docs.append((k * 10 + 5, " ".join(w), None, None, None))
        w = list(w)
        w[k * 12 : k * 12 + 11] = [f"n{k}{x}" for x in rng.integers(0, 9999, 11)]
    df = cases.table(spark, docs)
    expected = brute(cases.pairs_of(df))
    assert len({c for _, _, c in expected}) == 1
    assert found(df) == expected


def test_empty_table(spark):
    assert N.near_duplicates(cases.table(spark, [])).collect() == []


def test_drop_keeps_one_of_each_group_and_every_column(spark):
    df = cases.table(spark, clash=True)
    kept = N.drop_near_duplicates(df)
    assert kept.columns == df.columns or sorted(kept.columns) == sorted(df.columns)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    expected = [d if d != -1 else None for d, _, c in brute(cases.pairs_of(df)) if c is None or c == d]
    assert sorted(map(str, ids)) == sorted(map(str, expected))


def test_registers_hold_leading_zeros_and_mantissa():
    low = np.uint64(0b1011 << 40)
    regs = N.sketch(np.array([(7 << N.VALUE_BITS) | int(low)], np.uint64))
    assert set(regs) == {(N.VALUE_BITS - 44) * 1024 + (0b011 << 7)}  # an only bucket lends to all


def test_estimate_is_close(spark):
    rng = np.random.default_rng(0)
    out = []
    for share in (0.5, 0.8, 0.95):
        common, own = int(2000 * share), int(2000 * (1 - share) / 2)
        pool = np.sort(mix64(rng.integers(0, 1 << 62, common + 2 * own).astype(np.uint64)))
        pick = rng.permutation(len(pool))
        a, b = (np.sort(np.concatenate([pool[pick[:common]], pool[pick[common + k * own : common + (k + 1) * own]]])) for k in (0, 1))
        out.append((share, *(N.sketch(x).view(np.int64).tolist() for x in (a, b)), len(a), len(b)))
    df = spark.createDataFrame(out, "share double, a array<long>, b array<long>, n long, m long")
    for r in df.select("share", N.estimate(F.col("a"), F.col("b"), F.col("n"), F.col("m")).alias("e")).collect():
        assert abs(r.share - r.e) < 0.11


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + i, 101 + i) for i in range(30)]
    parent = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            m = min(parent[a], parent[b])
            parent[a] = parent[b] = m
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {x: got.get(x, x) for x in parent} == parent


def test_small_sets_are_compared_exactly(spark):
    # 6 of 7, 7 of 8 and 17 of 20 shingles shared: some estimates are far too low
    rng = np.random.default_rng(8)
    rows, far = [], 0
    for n, m in ((6, 7), (7, 8), (17, 20)):
        for _ in range(2000):
            pool = np.unique(mix64(rng.integers(0, 1 << 62, m).astype(np.uint64)))
            part = np.sort(rng.permutation(pool)[:n])
            far += (N.sketch(part) == N.sketch(pool)).mean() < 0.75
            rows.append([N.sketch(x).view(np.int64).tolist() if k else len(x) for k in (0, 1) for x in (part, pool)] + [x.view(np.int64).tolist() for x in (part, pool)])
    assert far
    df = spark.createDataFrame(rows, "na long, nb long, sa array<long>, sb array<long>, a array<long>, b array<long>")
    sides = df.select(*[F.struct(F.col(f"n{s}").alias("n_shingles"), F.col(f"s{s}").alias("sketch"), F.col(s).alias("small")).alias(f"x{s}") for s in "ab"])
    assert sides.where(N._possible("xa", "xb", 85)).count() == len(rows)
    assert sides.where(N._possible("xa", "xb", 90)).count() == 0


def test_copies_just_under_the_threshold_are_not_listed(spark):
    """1,500 documents that add their own words to a common text, alike at 0.70 to 0.79 pairwise: few candidates, and no link is lost."""
    rng = np.random.default_rng(8)
    base = [f"b{i}" for i in range(300)]
    rows = [(k, " ".join(base + [f"n{k}x{j}" for j in range(rng.integers(42, 55))]), None, None, None) for k in range(1500)]
    rows.append((5000, rows[7][1] + " other", None, None, None))
    some = [shingles(r[1]) for r in rows[:60]]
    alike = [len(x & y) / len(x | y) for x, y in combinations(some, 2)]
    assert 0.70 < min(alike) and max(alike) < 0.80
    listed = []
    whole = N._confirmed
    N._confirmed = lambda pairs, sets, percent: (listed.append(pairs.count()), whole(pairs, sets, percent))[1]
    try:
        got = {r.doc_id: r.component_id for r in N.near_duplicates(cases.table(spark, rows), 80).collect()}
    finally:
        N._confirmed = whole
    assert sum(listed) < 10 * len(rows)
    assert got == {r[0]: 7 if r[0] == 5000 else r[0] for r in rows}
